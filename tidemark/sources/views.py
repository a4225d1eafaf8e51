"""Inputs of the operators, shaped from the order, item and event tables.

Each function takes a reader ``table(name) -> DataFrame`` and returns a lazy
DataFrame, so Catalyst prunes columns and pushes filters through to the scan.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.session import fit_input

Reader = Callable[[str], DataFrame]

TEAM_COUNT = 25


def stored_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of a file, or of all files in a folder, wherever it is."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    system = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return system.getContentSummary(where).getLength()


def parquet_reader(spark: SparkSession, folder: str) -> Reader:
    """Reader of the tables in a folder; each table's schema is looked up once.

    The session's shuffles are fitted to the bytes of the tables that were asked for.
    """
    schemas: dict[str, StructType] = {}
    sizes: dict[str, int] = {}

    def table(name: str) -> DataFrame:
        path = f"{folder}/{name}.parquet"
        if name not in schemas:
            schemas[name] = spark.read.parquet(path).schema
            sizes[name] = stored_bytes(spark, path)
            fit_input(spark, sum(sizes.values()))
        return spark.read.schema(schemas[name]).parquet(path)

    return table


def _text(prefix: str, column: str) -> Column:
    return F.concat(F.lit(prefix), F.col(column).cast("string"))


def _whole(value: Column | str) -> Column:
    return F.floor(value).cast("int")


def _quarters(amount: str, unit: int) -> Column:
    return F.floor(F.col(amount) / unit).cast("double") / 4


def _twice(rows: DataFrame, repeated: Column) -> DataFrame:
    """Rows, with those marked repeated given twice, in one pass."""
    copies = F.when(repeated, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return rows.withColumn("_copy", F.explode(copies)).drop("_copy")


def actor_films(table: Reader) -> DataFrame:
    orders, customer = table("orders"), table("customer")
    return orders.join(customer, orders.o_custkey == customer.c_custkey).select(
        F.col("c_name").alias("actor"),
        _text("A", "c_custkey").alias("actorid"),
        _text("Film#", "o_orderkey").alias("film"),
        F.year("o_orderdate").alias("year"),
        _whole("o_totalprice").alias("votes"),
        _quarters("o_totalprice", 12500).alias("rating"),
        _text("F", "o_orderkey").alias("filmid"),
    )


def player_seasons(table: Reader) -> DataFrame:
    """Orders are reduced per customer and year before the customer join."""
    quality = _quarters("o_totalprice", 5000)
    yearly = (
        table("orders")
        .groupBy("o_custkey", F.year("o_orderdate").alias("season"))
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.sum(quality).alias("q_sum"),
            F.min(quality).alias("q_min"),
            F.max(quality).alias("q_max"),
        )
    )
    customer = table("customer")
    k = F.max("c_custkey")
    return (
        yearly.join(customer, yearly.o_custkey == customer.c_custkey)
        .groupBy(F.col("c_name").alias("player_name"), "season")
        .agg(
            F.concat(F.lit("H"), (k % 30).cast("string")).alias("height"),
            F.max("c_mktsegment").alias("college"),
            F.max("c_nationkey").cast("string").alias("country"),
            (k % 5 + 1990).cast("string").alias("draft_year"),
            (k % 60).cast("string").alias("draft_number"),
            (k % 2 + 1).cast("string").alias("draft_round"),
            F.sum("n").cast("int").alias("gp"),
            (F.sum("q_sum") / F.sum("n")).alias("pts"),
            F.min("q_min").alias("reb"),
            F.max("q_max").alias("ast"),
        )
    )


def games(table: Reader) -> DataFrame:
    home = (F.col("o_custkey") % TEAM_COUNT).cast("int")
    visitor = (home + 1 + F.col("o_orderkey") % (TEAM_COUNT - 1)) % TEAM_COUNT
    return table("orders").select(
        F.col("o_orderkey").alias("game_id"),
        F.to_date("o_orderdate").alias("game_date_est"),
        F.year("o_orderdate").alias("season"),
        home.alias("home_team_id"),
        visitor.cast("int").alias("visitor_team_id"),
        F.when(F.col("o_orderstatus") == "F", 1).otherwise(0).alias("home_team_wins"),
        (_whole("o_totalprice") % 60 + 70).alias("pts_home"),
        (_whole("o_totalprice") % 50 + 70).alias("pts_away"),
    )


def game_details(table: Reader, names: bool = True, of: DataFrame | None = None) -> DataFrame:
    """One row per item of a game; games divisible by 100 are given twice.

    Player names need a join of their own, left out where nobody reads them. Given ``of``,
    rows of the games in it only, which are chosen before any item meets its game.
    """
    lineitem, part = table("lineitem"), table("part")
    match = games(table).select("game_id", "home_team_id", "visitor_team_id")
    if of is not None:
        match = match.join(of.select("game_id"), "game_id", "left_semi")
    q, n = F.col("l_quantity").cast("int"), F.col("l_linenumber")
    absent = n >= 5
    team = F.when(n % 2 == 0, F.col("home_team_id")).otherwise(F.col("visitor_team_id"))
    items = lineitem.join(match, lineitem.l_orderkey == match.game_id)
    name = []
    if names:
        items = items.join(part, lineitem.l_partkey == part.p_partkey)
        full = F.concat("p_name", F.lit("#"), F.col("p_partkey").cast("string"))
        name = [full.alias("player_name")]
    rows = (
        items.select(
            "game_id",
            team.alias("team_id"),
            F.concat(F.lit("T"), team.cast("string")).alias("team_abbreviation"),
            F.col("l_partkey").alias("player_id"),
            *name,
            F.col("l_returnflag").alias("start_position"),
            F.when(n == 5, "DNP - Coach")
            .when(n == 6, "DND - Injury")
            .when(n == 7, "NWT - Personal")
            .alias("comment"),
            F.when(
                ~absent,
                F.concat(
                    q.cast("string"), F.lit(":"), F.lpad((n * 7).cast("string"), 2, "0")
                ),
            ).alias("min"),
            F.when(~absent, q).alias("pts"),
            (q % 11).alias("fgm"),
            (q % 11 + n).alias("fga"),
            (q % 5).alias("fg3m"),
            (q % 5 + n % 3).alias("fg3a"),
            (q % 7).alias("ftm"),
            (q % 7 + n % 2).alias("fta"),
            (q % 4).alias("oreb"),
            (q % 9).alias("dreb"),
            (q % 4 + q % 9).alias("reb"),
            (q % 8).alias("ast"),
            (q % 3).alias("stl"),
            (q % 2).alias("blk"),
            (n % 4).alias("turnovers"),
            (n % 6).alias("pf"),
            (q % 41 - 20).alias("plus_minus"),
        )
    )
    return _twice(rows, F.col("game_id") % 100 == 0)


def teams(table: Reader) -> DataFrame:
    nation, region = table("nation"), table("region")
    key = F.col("n_nationkey")
    rows = nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        key.alias("team_id"),
        _text("T", "n_nationkey").alias("abbreviation"),
        F.col("n_name").alias("nickname"),
        F.col("r_name").alias("city"),
        F.concat("n_name", F.lit(" Arena")).alias("arena"),
        (key + 1946).alias("yearfounded"),
    )
    return _twice(rows, F.col("team_id") < 5)


def events_web(table: Reader) -> DataFrame:
    k = F.get_json_object("props", "$.k").cast("int")
    event_id = F.col("event_id")
    return table("events").select(
        F.when(event_id % 50 != 0, F.col("user_id")).alias("user_id"),
        k.alias("device_id"),
        F.when(event_id % 97 != 0, F.concat(F.lit("host"), (k % 5).cast("string"))).alias("host"),
        F.when(F.col("event_type") == "purchase", F.lit("/api/v1/login"))
        .otherwise(F.concat(F.lit("/"), F.col("event_type")))
        .alias("url"),
        F.col("ts").alias("event_time"),
    )


def devices(table: Reader) -> DataFrame:
    key = F.col("p_partkey")
    browser = F.split_part("p_name", F.lit(" "), F.lit(1))
    return table("part").select(
        key.alias("device_id"),
        F.when(key % 10 != 0, F.col("p_type")).alias("os_type"),
        F.col("p_brand").alias("device_type"),
        F.when(key % 13 != 0, browser).alias("browser_type"),
    )
