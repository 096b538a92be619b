"""Best-fit packing of token sequences with Martello-Toth dominance reduction.

Documents become token ids and an end mark; only documents longer than a sequence are cut. Lengths are whole
numbers up to the capacity, so all that the packing depends on is how many pieces have each length: a table
of at most `capacity` rows, whatever the corpus. The packing is worked out on it in runs ("the next n pieces
of length l go to sequences s, s + 1, ..., k to each, from place o") and Spark gives every piece its place by
its position among the pieces of its length. Only that table and the runs pass the driver.

Null and empty texts are documents of one token, the end mark. Repeated rows are packed each by themselves.
Ties (pieces of one length) go by doc_id, then piece. Texts are taken whole, words of any length included.
An empty table gives no sequences.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from labtrail.llm.common import positions, query, staged, table

CAPACITY = 4096
END = 1
TOKENIZER = "word_bpe_49k.json"
CACHED_WORDS = 400_000


# ---------------------------------------------------------------- tokens


class WordTokens(dict):
    """Token ids of single words, as little-endian unsigned 32-bit numbers, each worked out once.

    For tokenizers that drop white space and never join across it: then the ids of a text are the ids of its
    words in order. A word of plain characters falls apart into letter runs, digits and the rest in one known
    way, and the parts, which far fewer words are made of, go to the tokenizer's model and are kept as well.
    Any other word goes to the tokenizer whole. A cache that holds `most` entries is set aside and a new one
    filled, first from the one set aside; that bounds the memory and nothing else.
    """

    # Words of these characters need no Unicode composition, and their lower case is one character each.
    PLAIN = re.compile(r"[!-~À-ÖØ-öø-ÿ]+")
    # How the tokenizer word_bpe_49k splits words, for plain characters in lower case.
    PARTS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-zß-öø-ÿ0-9]+")

    def __init__(self, path: str, most: int = CACHED_WORDS):
        from tokenizers import Tokenizer, pre_tokenizers

        super().__init__({"": b""})
        self.whole = Tokenizer.from_file(path)
        self.model = self.whole.model
        self.most = most
        self.before: dict[str, bytes] = {}
        self.parts: dict[str, bytes] = {}
        self.parts_before: dict[str, bytes] = {}
        # how the model's vocabulary spells each byte of a plain character
        spell = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str
        self.spelled = {c: spell(chr(c))[0][0] for c in range(0xC0, 0x100)}

    def _part(self, part: str) -> bytes:
        ids = self.parts.get(part)
        if ids is None:
            ids = self.parts_before.get(part)
            if ids is None:
                spelled = part if part.isascii() else part.translate(self.spelled)
                ids = b"".join([t.id.to_bytes(4, "little") for t in self.model.tokenize(spelled)])
            if len(part) <= 64:
                if len(self.parts) >= self.most:
                    self.parts_before, self.parts = self.parts, {}
                self.parts[part] = ids
        return ids

    def __missing__(self, word: str) -> bytes:
        ids = self.before.get(word)
        if ids is not None:
            pass
        elif "<|" not in word and self.PLAIN.fullmatch(word):
            ids = b"".join(map(self._part, self.PARTS.findall(word.lower())))
        else:
            ids = np.array(self.whole.encode(word, add_special_tokens=False).ids, dtype="<u4").tobytes()
        if len(word) <= 64:
            if len(self) >= self.most:
                self.before = dict(self)
                self.clear()
                self[""] = b""
            self[word] = ids
        return ids

    def of(self, text: str) -> bytes:
        for blank in "\n\t\r\v\f":
            if blank in text:
                text = text.replace(blank, " ")
        return b"".join(map(self.__getitem__, text.split(" ")))


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def pieces(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id", tokenizer: str = TOKENIZER,
    capacity: int = CAPACITY, keep_ids: bool = False,
) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, and the ids themselves if wanted."""
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * keep_ids

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = WordTokens(tokenizer_path(tokenizer))
        end = np.array([END], dtype="<u4").tobytes()
        width = 4 * capacity
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                some = batch.slice(at, 512)
                rows = []
                for name, body in zip(some.column(0).to_pylist(), some.column(1).to_pylist()):
                    data = tokens.of(body or "") + end
                    for k, start in enumerate(range(0, len(data), width)):
                        part = data[start : start + width]
                        row = (name, k, start // 4, len(part) // 4, zlib.crc32(part))
                        rows.append((*row, np.frombuffer(part, "<u4")) if keep_ids else row)
                columns = list(zip(*rows))
                kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32())]
                names = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(columns, kinds)], names=names[: len(columns)]
                )

    return docs.select(F.col(doc_id).cast("long"), F.col(text)).mapInArrow(cut, schema)


# ---------------------------------------------------------------- the plan


class Run(NamedTuple):
    """The pieces of `length` at positions first .. first + n - 1: `per` to a sequence, from sequence `to` on."""

    length: int
    first: int
    n: int
    to: int
    per: int
    offset: int


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> tuple[list[Run], int, int]:
    """Runs for so many pieces of each length, the number of sequences, and how many of them are proven best.

    First the Martello-Toth reduction, over lengths from the longest: a sequence {j, k} or {j} is fixed for
    good if it dominates every other sequence with j, that is if k, the longest piece that fits beside j, is
    no shorter than any set of pieces that fits there (such a set could change places with k). That is so
    if k fills the sequence; if no two of the pieces left fit beside j; or if two fit but not three, and no
    two are longer together than k. What remains is placed by best fit, longest first.
    """
    left = {length: n for length, n in sorted(counts.items()) if n}
    used = dict.fromkeys(left, 0)
    lengths = sorted(left)
    runs: list[Run] = []
    sequences = 0

    def put(length: int, n: int, to: int, per: int, offset: int) -> None:
        runs.append(Run(length, used[length], n, to, per, offset))
        used[length] += n
        left[length] -= n
        if not left[length]:
            lengths.pop(bisect_left(lengths, length))

    def smallest(n: int, but: int) -> list[int]:
        """The n smallest pieces left when one of length `but` is set aside."""
        out: list[int] = []
        for length in lengths:
            out += [length] * min(n - len(out), left[length] - (length == but))
            if len(out) == n:
                break
        return out

    def longest_two(room: int, but: int) -> int:
        """The greatest total of two pieces that fits in `room`, one of length `but` being set aside."""
        best, high = 0, len(lengths) - 1
        for low, a in enumerate(lengths):
            while high >= low and a + lengths[high] > room:
                high -= 1
            if high < low:
                break
            b = lengths[high]
            have = left[a] - (a == but), left[b] - (b == but)
            if (a == b and have[0] >= 2) or (a != b and min(have) >= 1):
                best = max(best, a + b)
            elif high - 1 >= low and lengths[high - 1] != a:
                best = max(best, a + lengths[high - 1])
        return best

    def pair(j: int, k: int) -> None:
        nonlocal sequences
        n = left[j] // 2 if j == k else min(left[j], left[k])
        if j == k:
            put(j, 2 * n, sequences, 2, 0)
        else:
            put(j, n, sequences, 1, 0)
            put(k, n, sequences, 1, j)
        sequences += n

    for j in sorted(left, reverse=True):
        while left[j]:
            room = capacity - j
            others = smallest(3, j)
            if not others or others[0] > room:
                n = left[j] if not others or others[0] != j else left[j]
                put(j, n, sequences, 1, 0)
                sequences += n
                continue
            at = bisect_left(lengths, room + 1) - 1
            k = lengths[at]
            if k == j and left[j] < 2:
                k = lengths[at - 1] if at else 0
            if k == room or len(others) < 2 or others[0] + others[1] > room:
                pair(j, k)
            elif (len(others) < 3 or sum(others) > room) and longest_two(room, j) <= k:
                pair(j, k)
            else:
                break
    fixed = sequences

    # Best fit on groups of sequences with equal contents: room -> [(first sequence, how many)].
    rooms: list[int] = []
    open_: dict[int, list[tuple[int, int]]] = {}

    def opened(room: int, first: int, n: int) -> None:
        if n and room:
            if room not in open_:
                open_[room] = []
                insort(rooms, room)
            open_[room].append((first, n))

    for length in sorted(left, reverse=True):
        while left[length]:
            at = bisect_left(rooms, length)
            if at < len(rooms):
                room = rooms[at]
                first, n = open_[room].pop()
                if not open_[room]:
                    del open_[room]
                    rooms.pop(at)
            else:
                room, first, n = capacity, sequences, -(-left[length] // (capacity // length))
                sequences += n
            per = room // length
            full, rest = divmod(min(left[length], n * per), per)
            if full:
                put(length, full * per, first, per, capacity - room)
                opened(room - per * length, first, full)
            if rest:
                put(length, rest, first + full, rest, capacity - room)
                opened(room - rest * length, first + full, 1)
            opened(room, first + full + bool(rest), n - full - bool(rest))
    return runs, sequences, fixed


def pack(cut: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """`cut` (rows with length, doc_id, piece) with sequence_id and offset.

    The runs are a few for each length, at most `capacity` lengths: their size is bounded by the capacity.
    """
    counts = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    runs, _, _ = plan(counts, capacity)
    runs.sort()
    # position within all pieces, lengths one after another: one search finds length and run
    base, total = {}, 0
    for length in sorted(counts):
        base[length] = total
        total += counts[length]
    starts = np.array([base[r.length] + r.first for r in runs], dtype=np.int64)
    bases = np.zeros(capacity + 1, dtype=np.int64)
    bases[list(base)] = list(base.values())
    figures = np.array([(r.first, r.to, r.per, r.offset) for r in runs], dtype=np.int64).reshape(-1, 4)
    shared = cut.sparkSession.sparkContext.broadcast((starts, bases, figures))
    placed = positions(cut, ["length"], ["doc_id", "piece"], "__place")
    schema = placed.drop("__place").schema.add("sequence_id", "long").add("offset", "long")

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        starts, bases, figures = shared.value
        for batch in batches:
            length = batch.column(batch.schema.get_field_index("length")).to_numpy()
            rank = batch.column(batch.schema.get_field_index("__place")).to_numpy()
            run = np.searchsorted(starts, bases[length] + rank, side="right") - 1
            first, to, per, offset = figures[run].T
            nth = rank - first
            kept = [i for i, name in enumerate(batch.schema.names) if name != "__place"]
            yield pa.RecordBatch.from_arrays(
                [batch.column(i) for i in kept] + [pa.array(to + nth // per), pa.array(offset + nth % per * length)],
                names=[batch.schema.names[i] for i in kept] + ["sequence_id", "offset"],
            )

    return placed.mapInArrow(place, schema)


def pack_documents(docs: DataFrame, tokenizer: str = TOKENIZER, capacity: int = CAPACITY, keep_ids: bool = False) -> DataFrame:
    """Tokenize, cut and pack: one row per piece with its place."""
    return pack(staged(pieces(docs, tokenizer=tokenizer, capacity=capacity, keep_ids=keep_ids), "pieces"), capacity)


@query("op5_best_fit_packing")
def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"))
