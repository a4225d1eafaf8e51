"""Audits of declared tables built from the inputs."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame

from tidemark.operators import cumulative, datelist, facts, graph, growth, monthly, quality
from tidemark.operators import scd, tracking
from tidemark.operators.cumulative import ACTOR_HISTORY, PLAYER_HISTORY
from tidemark.operators.scd import ACTOR_SCD, PLAYER_SCD
from tidemark.plans.activity import FIRST as FIRST_DAY
from tidemark.plans.activity import LAST as LAST_DAY
from tidemark.plans.activity import USER, USER_BROWSER, USER_HOST
from tidemark.sources import schemas, views
from tidemark.sources.views import Reader

LAST = 2001


def _player_tables(table: Reader) -> list[tuple[DataFrame, schemas.Table]]:
    players = cumulative.cumulate_backfill(
        views.player_seasons(table), PLAYER_HISTORY, LAST, attributes="none"
    )
    history = scd.scd2_build(players, PLAYER_SCD, LAST)
    states = tracking.track_state_through(tracking.tracked_seasons(players, history))
    return [
        (players, schemas.PLAYERS),
        (history, schemas.PLAYERS_SCD),
        (states, schemas.PLAYER_TRACKING),
    ]


def _actor_tables(table: Reader) -> list[tuple[DataFrame, schemas.Table]]:
    actors = cumulative.cumulate_backfill(
        views.actor_films(table),
        ACTOR_HISTORY,
        LAST,
        fold=True,
        attributes="latest",
        elements=False,
    )
    history = scd.scd2_build(actors, ACTOR_SCD, LAST)
    return [(actors, schemas.ACTORS), (history, schemas.ACTOR_HISTORY_SCD)]


def _activity_tables(table: Reader) -> list[tuple[DataFrame, schemas.Table]]:
    events = views.events_web(table)
    browsers = datelist.browser_events(events, views.devices(table))
    users = datelist.active_days(events, USER, last=LAST_DAY)
    hosts = datelist.active_days(events, USER_HOST, last=LAST_DAY)
    named = datelist.active_days(browsers, USER_BROWSER, last=LAST_DAY)
    dates = "dates_active"
    return [
        (datelist.datelist_through(users, USER, dates, LAST_DAY), schemas.USERS_CUMULATED),
        (
            datelist.datelist_through(named, USER_BROWSER, dates, LAST_DAY),
            schemas.USER_DEVICES_CUMULATED,
        ),
        (datelist.datelist_through(hosts, USER_HOST, dates, LAST_DAY), schemas.HOSTS_CUMULATED),
        (
            monthly.month_arrays(monthly.calendar_through(hosts, LAST_DAY, FIRST_DAY)),
            schemas.HOST_ACTIVITY_REDUCED,
        ),
        (growth.growth_backfill(users, LAST_DAY), schemas.USERS_GROWTH_ACCOUNTING),
    ]


def _game_tables(table: Reader) -> list[tuple[DataFrame | list[DataFrame], schemas.Table]]:
    details, games = views.game_details(table), views.games(table)
    # Neither keys nor domains read a name, but pairs are ordered by it.
    unnamed = views.game_details(table, names=False)
    vertices = (
        graph.game_vertices(games)
        .unionByName(graph.player_vertices(graph.without_names(unnamed)))
        .unionByName(graph.team_vertices(views.teams(table)))
    )
    # Kinds of edges differ in the key, so they are audited one by one.
    edges = [graph.plays_in_edges(unnamed), graph.player_edges(details)]
    return [
        (facts.build_fact(details, games), schemas.FACT_GAME_DETAILS),
        (vertices, schemas.VERTICES),
        (edges, schemas.EDGES),
    ]


def table_audits(table: Reader) -> DataFrame:
    """Keys and domains of every declared table that has a key."""
    built = [
        *_player_tables(table),
        *_actor_tables(table),
        *_activity_tables(table),
        *_game_tables(table),
    ]
    audits = [
        quality.parts_audit(rows, declared)
        if isinstance(rows, list)
        else quality.table_audit(rows, declared)
        for rows, declared in built
    ]
    return reduce(DataFrame.unionByName, audits)


QUERIES = {"table_audits": table_audits}
