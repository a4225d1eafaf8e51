"""SentencePiece encoding of merge-type models by backtracking, and decoding.

A sequence of pieces is what merging would give if and only if each two neighbours
are what merging gives for their text. So an encoder may walk the text with the
longest piece at each place, found by an Aho-Corasick automaton, keep it if it goes
with the piece before, and otherwise try the next shorter piece or go back; a
bitfield marks places from which no way leads on, so that none is tried twice.
Whether two pieces go together is found by merging their text again, and
remembered.

No piece of such a model has a space mark after another character. Encoding
therefore falls apart before each space, and a Python worker remembers the ids of
stretches, as many as its memory is given. Runs of space marks hold pieces of equal
score, whose order merging decides by place; they are merged directly.

Cases: a null or empty text has the end id alone and decodes to an empty text;
characters that the model does not know become bytes; ids and rows may repeat, each
row is encoded alone; tables may be empty; other columns are left behind.
"""

from __future__ import annotations

import heapq
import re
from array import array
from collections.abc import Iterator
from functools import cache
from itertools import islice

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tidemark.llm.common import prepare, slices

SPACE = "▁"
#: Distinct stretches whose ids a Python worker keeps.
REMEMBERED = 600_000
#: A longer stretch is encoded but not kept.
LONGEST_KEPT = 48
#: Piece pairs whose answer is kept.
PAIRS_KEPT = 500_000
#: A stop after a letter. If no piece holds the two, they are encoded
#: apart, and the mark says that no space was between.
INSIDE = re.compile("[A-Za-zÀ-ÖØ-öø-ÿ][.,]")
STOP = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ])([.,])(?=\s|$)")
JOINED = "\x02"
STOPPED = rf"\1 {JOINED}\2"
#: Longer texts are merged with a heap.
SHORT = 64

ENCODED = "doc_id long, ids array<int>, decoded string"


def _own_text(stretch: str) -> str:
    """The text that a stretch stands for, with the space put before it."""
    return stretch[1:] if stretch[:1] == JOINED else " " + stretch


class Pieces:
    """Pieces of a merge-type model and the two directions."""

    def __init__(self, path: str, remembered: int = REMEMBERED) -> None:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        self.end_id = model.eos_id()
        self.names = [model.id_to_piece(i) for i in range(size)]
        self.bytes = {
            i: int(self.names[i][3:5], 16) for i in range(size) if model.is_byte(i)
        }
        self.unspoken = {i for i in range(size) if i in self.bytes or model.is_control(i)}
        self.silent = {i for i in range(size) if model.is_control(i)}
        plain = [
            i
            for i in range(size)
            if not (i in self.bytes or i in self.silent or model.is_unknown(i))
        ]
        self.score = {self.names[i]: model.get_score(i) for i in plain}
        self.id_of = {self.names[i]: i for i in plain}
        self.byte_ids = [model.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        if any(SPACE in name.lstrip(SPACE) for name in self.score):
            raise ValueError(f"{path} has pieces that reach over a space")
        if any(c not in self.score for name in self.score for c in name):
            raise ValueError(f"{path} has pieces of characters it does not know")
        self.stops = not any(INSIDE.search(name) for name in self.score)
        self.searcher = ahocorasick.Automaton()
        # Pieces that merging never leaves whole are no candidates.
        reached = {name for name in self.score if self.merged(name) == [name]}
        for name in reached:
            self.searcher.add_word(name, (len(name) - 1, name))
        self.searcher.make_automaton()
        self.shorter = {
            name: next((name[:k] for k in range(len(name) - 1, 0, -1) if name[:k] in reached), None)
            for name in reached
        }
        self.pairs: dict[tuple[str, str], bool] = {}
        self.remembered = remembered
        self.known: dict[str, bytes] = {}
        #: What stretches decode to, where that is not their own text.
        self.said: dict[str, str] = {}

    def merged(self, text: str) -> list[str]:
        """Pieces by merging: the best-scored pair first, of equals the leftmost."""
        if len(text) > SHORT:
            return self._merged_long(text)
        parts, score = list(text), self.score
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                value = score.get(parts[i] + parts[i + 1])
                if value is not None and (best is None or value > best):
                    best, at = value, i
            if best is None:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def _merged_long(self, text: str) -> list[str]:
        n = len(text)
        parts: list[str | None] = list(text)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap: list[tuple[float, int, str]] = []

        def offer(i: int) -> None:
            if i >= 0 and (j := after[i]) < n:
                pair = parts[i] + parts[j]
                if (value := self.score.get(pair)) is not None:
                    heapq.heappush(heap, (-value, i, pair))

        for i in range(n - 1):
            offer(i)
        while heap:
            _, i, pair = heapq.heappop(heap)
            if parts[i] is None or (j := after[i]) >= n or parts[i] + parts[j] != pair:
                continue
            parts[i], parts[j] = pair, None
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
            offer(before[i])
            offer(i)
        return [x for x in parts if x is not None]

    def together(self, left: str, right: str) -> bool:
        """Whether merging the two pieces' text gives the two pieces."""
        found = self.pairs.get((left, right))
        if found is None:
            if len(self.pairs) >= PAIRS_KEPT:
                self.pairs = dict(islice(self.pairs.items(), PAIRS_KEPT // 2))
            found = self.pairs[left, right] = self.merged(left + right) == [left, right]
        return found

    def _backtracked(self, text: str, longest: dict[int, str], first: int = 0) -> list[int]:
        """Ids of a stretch of known characters, which begins at place ``first``."""
        n, at, pieces = len(text), 0, []
        dead = 0  # bits of places from which no way leads on
        pairs, together, shorter = self.pairs, self.together, self.shorter
        piece, last = longest[first], None
        while at < n:
            end = at + len(piece)
            fits = last is None or pairs.get((last, piece))
            if fits is None:
                fits = together(last, piece)
            if fits and not (dead and dead >> end & 1):
                pieces.append(piece)
                at, last = end, piece
                if at < n:
                    piece = longest[first + at]
                continue
            piece = shorter[piece]
            while piece is None:
                dead |= 1 << at
                piece = shorter[back := pieces.pop()]
                at -= len(back)
                last = pieces[-1] if pieces else None
        return list(map(self.id_of.__getitem__, pieces))

    def ids_of(self, text: str) -> list[int]:
        """Ids of a stretch; characters that are no pieces as their bytes."""
        if text.startswith(SPACE * 2):
            found = []
            for part in self.merged(text):
                if part in self.id_of:
                    found.append(self.id_of[part])
                else:
                    found.extend(self.byte_ids[b] for b in part.encode())
            return found
        # Of the matches at a place the longest ends last.
        longest = {end - k: piece for end, (k, piece) in self.searcher.iter(text)}
        if len(longest) == len(text):
            return self._backtracked(text, longest)
        found, at = [], 0
        while at < len(text):
            if at not in longest:
                found.extend(self.byte_ids[b] for b in text[at].encode())
                at += 1
                continue
            end = next((i for i in range(at, len(text)) if i not in longest), len(text))
            found += self._backtracked(text[at:end], longest, at)
            at = end
        return found

    def spoken(self, ids: list[int]) -> str:
        """Text of ids, space marks as spaces."""
        if self.unspoken.isdisjoint(ids):
            return "".join(map(self.names.__getitem__, ids)).replace(SPACE, " ")
        out, held = [], bytearray()
        for i in ids:
            if i in self.bytes:
                held.append(self.bytes[i])
                continue
            if held:
                out.append(held.decode("utf-8", "replace"))
                held = bytearray()
            if i not in self.silent:
                out.append(self.names[i])
        if held:
            out.append(held.decode("utf-8", "replace"))
        return "".join(out).replace(SPACE, " ")

    def decode(self, ids: list[int]) -> str:
        """Text of a document's ids: the space put before it goes."""
        return self.spoken(ids).removeprefix(" ")

    def _learn(self, stretch: str) -> None:
        """Remember a stretch, which begins with a space mark unless told otherwise."""
        ids = self.ids_of(stretch[1:] if stretch[:1] == JOINED else SPACE + stretch)
        self.known[stretch] = array("i", ids).tobytes()
        if (spoken := self.spoken(ids)) != _own_text(stretch):
            self.said[stretch] = spoken

    def _decoded(self, part: list[str]) -> str:
        """What known stretches decode to, one after another."""
        if not part:
            return ""
        if self.said.keys().isdisjoint(part):
            # A mark within a stretch is of the text; before one it says that no space was there.
            text = " " + " ".join(part)
            if text.count(JOINED) == text.count(" " + JOINED):
                return text.replace(" " + JOINED, "")
        own = map(_own_text, part)
        return "".join(map(self.said.get, part, own))

    def round_trip(self, texts: list[str | None]) -> tuple[list[np.ndarray], list[str]]:
        """Ids of each text, the end id last, and the text they decode to."""
        end = np.array([self.end_id], np.int32).tobytes()
        ids, decoded, long = [], [], []
        for text in texts:
            part = self._stretches(text or "")
            numbers = list(map(self.known.get, part))
            if None in numbers:
                for i, x in enumerate(numbers):
                    if x is None:
                        if (s := part[i]) not in self.known:
                            self._learn(s)
                            if len(s) > LONGEST_KEPT:
                                long.append(s)
                        numbers[i] = self.known[s]
            ids.append(np.frombuffer(b"".join((*numbers, end)), np.int32))
            decoded.append(self._decoded(part).removeprefix(" "))
        for s in long:
            del self.known[s]
            self.said.pop(s, None)
        if len(self.known) > self.remembered:
            # What came first is what comes often.
            self.known = dict(islice(self.known.items(), self.remembered // 2))
            self.said = {s: said for s, said in self.said.items() if s in self.known}
        return ids, decoded

    def _stretches(self, text: str) -> list[str]:
        """Stretches that are encoded alone, without the space mark most begin with."""
        if not text:
            return []
        if SPACE in text or "  " in text or text[0] == " " or text[-1] == " " or JOINED in text:
            marked = SPACE + text.replace(" ", SPACE)
            found = re.findall(f"{SPACE}+[^{SPACE}]*", marked)
            return [JOINED + s if s[1:2] == JOINED else s[1:] for s in found]
        if self.stops:
            text = STOP.sub(STOPPED, text)
        return text.split(" ")


@cache
def pieces(path: str) -> Pieces:
    """The model of a Python worker, which outlives its tasks."""
    return Pieces(path)


def round_trip(docs: DataFrame, model: str) -> DataFrame:
    """Each document's ids, the end id last, and the text that they decode to."""
    prepare(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = pieces(model)
        for batch in slices(batches):
            ids, decoded = held.round_trip(batch.column("text").to_pylist())
            ends = np.cumsum([0, *map(len, ids)])
            yield pa.record_batch(
                {
                    "doc_id": batch.column("doc_id"),
                    "ids": pa.ListArray.from_arrays(
                        pa.array(ends.astype(np.int32)), pa.array(np.concatenate(ids))
                    ),
                    "decoded": pa.array(decoded, pa.string()),
                }
            )

    return docs.select("doc_id", "text").mapInArrow(run, ENCODED)
