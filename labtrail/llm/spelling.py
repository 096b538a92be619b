"""Spelling variant grouping: a bit-sliced position index finds the words that differ in one letter.

For each position and letter the index has a bitset over the vocabulary: the words with that letter in that place.
A word is looked up letter by letter, and two sets of vocabulary words are kept all along: those that agree
so far without an error, and those that agree with one. A bitwise step brings 64 words forward at once. Of
words with one error there are two kinds: one letter replaced, read at the same position, and one letter
inserted, read one position on. At the end the lengths decide: as long as the word (replaced) or one letter
longer (inserted). A deletion is an insertion seen from the other word, so each word looks for its equals in length
and for longer ones only.

The vocabulary is not compared whole with itself. Two words that differ in one letter agree in the first or in the
last half of the shorter one's letters, whichever the error is not in; so words meet by length and half. A group
that is still large is cut again by the halves of what lies between, until it is small or at most one letter
(two in longer words) is left between, which no more words can share than the alphabet has pairs. So groups are
bounded whatever the vocabulary, nothing is capped, and each group's index is built and read in one task.

A word's form is its near word that occurs most often, if it occurs `ratio` times as often; roots follow forms to
the last, doubling the steps each round (counts grow by the ratio, so there is no circle and few rounds).

What happens in odd cases: null and empty texts and those without letters give no words, and so does an empty table. A
null id counts as empty text where the id matters. Texts are read whole, however long. Repeated rows count as often as
they stand there. Of near words with equal counts the smallest in code-point order is the form. Words in the
given table that are null, shorter than the least length or listed twice: null and short ones are left out, counts
of the same word are added up. Other columns play no part, whatever their names.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from labtrail.llm.common import query, staged, table

LETTERS = r"A-Za-zÀ-ÿ"
LEAST_LENGTH, LEAST_COUNT, RATIO = 6, 5, 5
GROUP = 1_024  # words an index may hold before it is cut
STEP = 1 << 18  # bitsets brought forward together
TYPO = 199


# ---------------------------------------------------------------- vocabulary


def lower_ascii(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def vocabulary(
    docs: DataFrame, change: Callable[[Column, Column], Column] | None = None, least_length: int = LEAST_LENGTH,
    least_count: int = LEAST_COUNT, doc_id: str = "doc_id", text: str = "text",
) -> DataFrame:
    """The words of the texts and how often they occur, `word` and `n`: runs of letters, A-Z in lower case.

    `change` may make another word of an id (as text) and a run. Only runs of the least length are read.
    """
    run = rf"[{LETTERS}]{{{least_length},}}"
    runs = docs.select(
        F.coalesce(F.col(doc_id).cast("string"), F.lit("")).alias("id"),
        F.explode(F.regexp_extract_all(F.col(text), F.lit(run), F.lit(0))).alias("run"),
    ).select("id", lower_ascii(F.col("run")).alias("run"))
    word = change(F.col("id"), F.col("run")) if change else F.col("run")
    counted = runs.select(word.alias("word")).where(F.length("word") >= least_length).groupBy("word")
    return counted.agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least_count)


def dropped_letter(doc_id: Column, run: Column) -> Column:
    """The run, less one letter where a hash of id and run says so."""
    hashed = F.crc32(F.concat(doc_id, F.lit(":"), run).cast("binary"))
    place = (hashed % F.length(run)).cast("int")
    less = F.concat(F.substring(run, F.lit(1), place), F.substring(run, place + 2, F.length(run)))
    return F.when(hashed % TYPO == 0, less).otherwise(run)


# ---------------------------------------------------------------- groups


def word_groups(words: DataFrame, least_length: int, most: int) -> DataFrame:
    """Groups of words (`words`: word, n) that may be near: each near pair is in one at least.

    `short` is the length of the shorter words of a group, which also holds words with one letter more; all
    agree in their first `head` and last `tail` letters.
    """
    length = F.length("word")
    rows = words.select(
        "word", "n", F.explode(F.array(length, length - 1)).alias("short"), F.lit(0).alias("head"), F.lit(0).alias("tail")
    ).where(F.col("short") >= least_length)
    key = ["short", "head", "tail", "first", "last"]
    between = F.col("short") - F.col("head") - F.col("tail")
    groups = []
    while True:
        keyed = rows.withColumns({
            "first": F.expr("substring(word, 1, head)"), "last": F.expr("substring(word, length(word) - tail + 1, tail)")
        })
        large = keyed.groupBy(*key).agg(F.count(F.lit(1)).alias("many")).where((F.col("many") > most) & (between > 1))
        # written, so that the joins below meet plain rows and adaptive execution can split a hot key
        large = staged(large.drop("many"), "large-groups")
        settled = keyed.join(large, key, "left_anti")
        groups.append(
            settled.groupBy(*key)
            .agg(F.collect_list(F.struct("word", "n")).alias("words"))
            .where((F.size("words") > 1) & F.exists("words", lambda w: F.length(w["word"]) == F.col("short")))
            .select("short", "head", "tail", "words")
        )
        if large.isEmpty():
            return reduce(DataFrame.union, groups)
        half = F.floor(between / 2).cast("int")
        ways = F.array(
            F.struct((F.col("head") + half).alias("head"), "tail"), F.struct("head", (F.col("tail") + half).alias("tail"))
        )
        cut = keyed.join(large, key, "left_semi").select("word", "n", "short", F.explode(ways).alias("way"))
        rows = staged(cut.select("word", "n", "short", "way.head", "way.tail"), "word-groups")


# ---------------------------------------------------------------- index


class PositionIndex:
    """Bitsets over the words of several groups, for words of `size` letters and of one more.

    A lane holds 64 words of one group, one bit each. `keys` are lane, position and letter in one number, in
    order, and `bits` the words of the lane with that letter there.
    """

    def __init__(self, groups: list[list[str]], size: int):
        self.size = size
        words = [w for group in groups for w in group]
        lengths = np.array([len(w) for w in words], dtype=np.int64)
        counts = np.array([len(g) for g in groups], dtype=np.int64)
        self.lanes = -(-counts // 64)
        self.first_lane = np.cumsum(self.lanes) - self.lanes
        first_word = np.cumsum(counts) - counts
        self.group = np.repeat(np.arange(len(groups)), counts)
        within = np.arange(len(words)) - first_word[self.group]
        lane = self.first_lane[self.group] + within // 64
        bit = np.uint64(1) << (within % 64).astype(np.uint64)
        self.word_of_lane = np.zeros(self.lanes.sum(), dtype=np.int64)
        self.word_of_lane[lane[within % 64 == 0]] = np.flatnonzero(within % 64 == 0)

        codes = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), "<u4")
        letters, letter = np.unique(codes, return_inverse=True)
        self.alphabet = max(len(letters), 1)
        start = np.cumsum(lengths) - lengths
        position = np.arange(len(codes)) - np.repeat(start, lengths)
        key = self.key(np.repeat(lane, lengths), position, letter)
        order = np.argsort(key, kind="stable")
        self.keys, at = np.unique(key[order], return_index=True)
        self.bits = np.bitwise_or.reduceat(np.repeat(bit, lengths)[order], at) if len(at) else np.zeros(0, np.uint64)

        self.as_long, self.longer = (self._sets(lane, bit, lengths == n) for n in (size, size + 1))
        self.queries = np.flatnonzero(lengths == size)
        self.letters = letter[start[self.queries][:, None] + np.arange(size)]

    def _sets(self, lane: np.ndarray, bit: np.ndarray, which: np.ndarray) -> np.ndarray:
        out = np.zeros(len(self.word_of_lane), dtype=np.uint64)
        np.bitwise_or.at(out, lane[which], bit[which])
        return out

    def key(self, lane: np.ndarray, position, letter: np.ndarray) -> np.ndarray:
        return (lane * (self.size + 1) + position) * self.alphabet + letter

    def having(self, lane: np.ndarray, position: int, letter: np.ndarray) -> np.ndarray:
        """The words of each lane that have the letter at the position."""
        if not len(self.keys):
            return np.zeros(len(lane), dtype=np.uint64)
        key = self.key(lane, position, letter)
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.bits[at], np.uint64(0))

    def near(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Word numbers of near pairs: words of `size` letters, and the near ones as long or one letter longer."""
        many = self.lanes[self.group[self.queries]]
        done = np.cumsum(many)
        a = 0
        while a < len(many):
            z = max(a + 1, int(np.searchsorted(done, done[a] - many[a] + STEP, side="right")))
            yield self._near(np.arange(a, z), many[a:z])
            a = z

    def _near(self, queries: np.ndarray, many: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        row = np.repeat(queries, many)
        intra = np.arange(len(row)) - np.repeat(np.cumsum(many) - many, many)
        lane = self.first_lane[self.group[self.queries[row]]] + intra
        agree = self.as_long[lane] | self.longer[lane]  # without an error so far
        replaced = np.zeros(len(row), dtype=np.uint64)  # one letter replaced so far
        inserted = np.zeros(len(row), dtype=np.uint64)  # one letter inserted so far, read one position on
        for i in range(self.size):
            letter = self.letters[row, i]
            here, next_ = self.having(lane, i, letter), self.having(lane, i + 1, letter)
            inserted = (inserted | agree) & next_
            replaced = (replaced & here) | (agree & ~here)
            agree &= here
        near = (replaced & self.as_long[lane]) | ((inserted | agree) & self.longer[lane])
        hit = np.flatnonzero(near)
        which, bit = np.nonzero(np.unpackbits(near[hit].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"))
        return self.queries[row[hit[which]]], self.word_of_lane[lane[hit[which]]] + bit


def pairs_of_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Near pairs of each batch's groups, both ways: `word`, `near`, and how often the near one occurs."""
    for batch in batches:
        by_size = defaultdict(list)
        for group in batch.to_pylist():
            by_size[group["short"] - group["head"] - group["tail"]].append(group)
        for size, groups in by_size.items():
            between = [[w["word"][g["head"] : len(w["word"]) - g["tail"]] for w in g["words"]] for g in groups]
            words = pa.array([w["word"] for g in groups for w in g["words"]], pa.string())
            n = pa.array([w["n"] for g in groups for w in g["words"]], pa.int64())
            index = PositionIndex(between, size)
            longer = np.array([len(w) > size for group in between for w in group])
            for word, near in index.near():
                back = longer[near]  # equals in length find each other, longer ones are found only
                word, near = np.concatenate([word, near[back]]), np.concatenate([near, word[back]])
                yield pa.RecordBatch.from_arrays([words.take(word), words.take(near), n.take(near)], names=["word", "near", "n"])


def near_pairs(words: DataFrame, least_length: int = LEAST_LENGTH, most: int = GROUP) -> DataFrame:
    """Each word with each of its near words and that one's count: `word`, `near`, `n`. Words are distinct."""
    groups = word_groups(words, least_length, most)
    return groups.mapInArrow(pairs_of_groups, "word string, near string, n long").distinct()


# ---------------------------------------------------------------- forms


def roots(forms: DataFrame) -> DataFrame:
    """The end of each word's chain of forms (`word`, `form`) as `root`: chains are halved until none is left."""
    now = staged(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = now.select(F.col("word").alias("root"), F.col("root").alias("__on"))
        met = staged(now.join(ahead, "root", "left"), "roots")
        if met.where("__on IS NOT NULL").isEmpty():
            return now
        now = met.select("word", F.coalesce("__on", "root").alias("root"))


def variants(
    words: DataFrame, ratio: int = RATIO, least_length: int = LEAST_LENGTH, most: int = GROUP
) -> DataFrame:
    """`words` (word, n) with their near words' number, form, its count and the root of the chain of forms."""
    words = words.where(F.length("word") >= least_length).groupBy("word").agg(F.sum("n").alias("n"))
    words = staged(words, "words")
    best = near_pairs(words, least_length, most).groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("n")).alias("less"), "near")).alias("best")
    )
    often = -F.col("best.less") >= ratio * F.col("n")
    found = words.join(best, "word", "left").select(
        "word",
        F.when(often, F.col("best.near")).alias("form"),
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(often, -F.col("best.less")).alias("form_n"),
    )
    found = staged(found, "forms")
    ends = roots(found.where("form IS NOT NULL"))
    return found.join(ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


# Bytes go through the checksum as themselves and then eight times a marker that asks for a shift of one bit.
SQL = rf"""
WITH RECURSIVE runs AS (
    SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]{{{LEAST_LENGTH},}}')) AS run FROM documents),
lowered AS (SELECT coalesce(doc_id::VARCHAR, '') AS id,
    translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS n FROM runs GROUP BY ALL),
fed AS (SELECT run, n, list_prepend(4294967295::BIGINT, flatten(list_transform(
    range(length(hex(id || ':' || run)) // 2),
    lambda i: list_prepend(('0x' || substr(hex(id || ':' || run), 2 * i + 1, 2))::BIGINT, [-1, -1, -1, -1, -1, -1, -1, -1]::BIGINT[])
    ))) AS steps FROM lowered),
hashed AS (SELECT run, n, xor(4294967295::BIGINT, list_reduce(steps,
    lambda c, x: CASE WHEN x >= 0 THEN xor(c, x) ELSE xor(c >> 1, 3988292384 * (c & 1)) END)) AS h FROM fed),
words AS (SELECT CASE WHEN h % {TYPO} = 0 THEN substr(run, 1, (h % length(run))::INTEGER) || substr(run, (h % length(run))::INTEGER + 2)
    ELSE run END AS word, sum(n)::BIGINT AS n FROM hashed GROUP BY 1 HAVING length(word) >= {LEAST_LENGTH} AND sum(n) >= {LEAST_COUNT}),
less AS (SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest
    FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)),
near AS (SELECT a.word, b.word AS near, b.n FROM less a JOIN less b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
    UNION SELECT a.word, b.word, b.n FROM less a JOIN words b ON a.rest = b.word
    UNION SELECT b.word, a.word, a.n FROM less a JOIN words b ON a.rest = b.word),
best AS (SELECT word, count(*) AS n_near, max(n) AS n FROM near GROUP BY word),
forms AS (SELECT words.word, words.n, coalesce(n_near, 0)::BIGINT AS n_near,
    CASE WHEN best.n >= {RATIO} * words.n THEN best.n END AS form_n,
    CASE WHEN best.n >= {RATIO} * words.n THEN (SELECT min(near.near) FROM near
        WHERE near.word = words.word AND near.n = best.n) END AS form
    FROM words LEFT JOIN best ON best.word = words.word),
chain AS (SELECT word, word AS at, form FROM forms
    UNION ALL SELECT chain.word, forms.word, forms.form FROM chain JOIN forms ON forms.word = chain.form)
SELECT forms.word, forms.form, chain.at AS root, forms.n, n_near, form_n
FROM forms JOIN chain ON chain.word = forms.word AND chain.form IS NULL
"""


@query("op11_spelling_variants", SQL)
def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return variants(vocabulary(docs, dropped_letter))
