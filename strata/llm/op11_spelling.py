"""Spelling variants: words one edit apart, found by scanning sorted lists.

A word's row of the edit matrix for the first d characters of another word
depends on those characters alone. In a sorted list, neighbours share a prefix
(their LCP), so the rows of that prefix are reused; a row has three cells (the
band of one edit), and where all of them exceed one edit, all words that share
the prefix are skipped.

The list of all words is cut into frames, so that no task holds it. Two words
one edit apart, the longer of m characters, share the first half of m or the last
half of m; so each word stands, for m = its length and m = its length + 1, in
the frame of its first half and in that of its last half, and every pair meets
in exactly one frame (by its common prefix). A frame of more than ``FRAME_ROWS``
words is cut again by halves of the middle that is still free, until it is
small or its middle is one character, when it cannot hold more words
than there are characters (and one). Nothing is dropped at any step.

``counted_words`` counts the words of texts, ``near_pairs`` finds all pairs,
``grouped`` gives every word its near count, form and root.

Null texts have no words; a null id hashes as empty text. Repeated rows count
again. Ties between forms go to the smallest word in code-point order. An
empty table gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections import Counter, defaultdict
from collections.abc import Iterator
from functools import partial
from zlib import crc32

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import map_batches, read, stored, texts_of

# Words are runs of these characters.
LETTERS = r"A-Za-zÀ-ÿ"
LEAST_CHARS = 6
LEAST_COUNT = 5
FORM_FACTOR = 5
TYPO_MODULUS = 199

# Most words of a frame that one task takes whole, and most words of a list
# that is scanned without another cut inside the task.
FRAME_ROWS = 5_000
SCAN_ROWS = 60

_LAST = "\U0010ffff"


def counted_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_chars: int = LEAST_CHARS,
                  least_count: int = LEAST_COUNT, typo_modulus: int | None = None) -> DataFrame:
    """(word, n): how often each word of at least ``least_chars`` characters
    stands in the texts, where at least ``least_count`` times.

    ``typo_modulus``: of runs whose crc32 of ``<id>:<run>`` it divides, one
    character (crc32 modulo length) is deleted first.
    """
    # runs below least_chars stay too short whatever is deleted
    find = re.compile(f"[{LETTERS}]{{{least_chars},}}").findall
    rows = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"), F.col(text_col).alias("text"))

    def make():
        def fn(batch):
            counts: Counter[str] = Counter()
            for key, text in zip(batch.column(0).to_pylist(), texts_of(batch)):
                runs = find(text.encode().lower().decode())     # bytes.lower: A-Z only
                if typo_modulus is not None:
                    start = crc32(f"{key}:".encode())
                    for i, run in enumerate(runs):
                        h = crc32(run.encode(), start)
                        if h % typo_modulus == 0:
                            at = h % len(run)
                            runs[i] = run[:at] + run[at + 1:]
                counts.update(runs)
            return pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())],
                                              ["word", "n"])
        return fn
    counted = map_batches(rows, make, "word string, n bigint")
    return (counted.groupBy("word").agg(F.sum("n").alias("n"))
            .filter((F.length("word") >= least_chars) & (F.col("n") >= least_count)))


def _cut_frames(rows: DataFrame) -> DataFrame:
    """Each row of a frame in its two halves: the free middle of ``free``
    characters (one less in a shorter word) shares its first ``half`` or its
    last ``half``. ``under`` bounds the common prefix from above where a last
    half was taken, so that a pair meets in one frame only."""
    half = (F.col("free") / 2).cast("int")
    halved = rows.withColumn("half", half)
    first = halved.select("m", F.expr("head + half").alias("head"), "tail", "under", "word")
    last = halved.select("m", "head", F.expr("tail + half").alias("tail"),
                         F.least("under", F.expr("head + half")).alias("under"), "word")
    return _framed(first.unionByName(last))


def _framed(rows: DataFrame) -> DataFrame:
    """With the frame's texts: ``head`` and ``tail`` are the numbers of fixed
    characters at both ends."""
    return (rows.withColumn("free", F.expr("m - head - tail"))
            .withColumn("frame", F.concat_ws(",", "m", "head", "tail", "under",
                                             F.expr("substring(word, 1, head)"),
                                             F.expr("right(word, tail)"))))


def near_pairs(words: DataFrame, frame_rows: int = FRAME_ROWS) -> DataFrame:
    """(a, b): all pairs of words (column ``word``, distinct, two characters or
    more) that differ by one inserted, deleted or replaced code point, once each."""
    length = F.length("word")
    rows = _cut_frames(words.select(
        "word", F.explode(F.array(length, length + 1)).alias("m"),
        F.lit(0).alias("head"), F.lit(0).alias("tail"), F.lit((1 << 31) - 1).alias("under"))
        .withColumn("free", F.col("m")))
    found = []
    while True:
        # frames by size; those that are too large and can be cut go round again
        sizes = rows.groupBy("frame").agg(F.count(F.lit(1)).alias("n"), F.first("free").alias("f"))
        large = stored(sizes.filter((F.col("n") > frame_rows) & (F.col("f") > 1)).select("frame"), "op11-large")
        if large.isEmpty():
            found.append(_scanned(rows))
            break
        found.append(_scanned(rows.join(large, "frame", "left_anti")))
        rows = stored(_cut_frames(rows.join(large, "frame", "left_semi").drop("frame", "free")
                                  .withColumn("free", F.expr("m - head - tail"))), "op11-frames")
    pairs = found[0]
    for more in found[1:]:
        pairs = pairs.unionByName(more)
    return pairs


def _scanned(rows: DataFrame) -> DataFrame:
    """Pairs of all frames; a task streams through its frames, one at a time."""
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = (rows.select("frame", "m", "head", "tail", "under", "word")
             .repartition(parts, "frame").sortWithinPartitions("frame", "word"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frame, words, shape = None, [], (0, 0, 0, 0)
        a, b = [], []
        for batch in batches:
            cols = [batch.column(c).to_pylist() for c in ("frame", "m", "head", "tail", "under", "word")]
            for f, m, head, tail, under, word in zip(*cols):
                if f != frame:
                    search(words, *shape, a, b)
                    frame, words, shape = f, [], (m, head, tail, under)
                words.append(word)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.string()), pa.array(b, pa.string())], ["a", "b"])
            a, b = [], []
        search(words, *shape, a, b)
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.string()), pa.array(b, pa.string())], ["a", "b"])
    return dealt.mapInArrow(run, "a string, b string")


def search(words: list[str], m: int, head: int, tail: int, under: int, a: list[str], b: list[str],
           scan_rows: int = SCAN_ROWS) -> None:
    """:func:`scan` of a frame's sorted words, cut like the frames first."""
    free = m - head - tail
    if len(words) <= scan_rows or free < 2:
        scan(words, m, head, under, a, b)
        return
    first, last = defaultdict(list), defaultdict(list)
    half = free // 2
    for word in words:
        first[word[:head + half]].append(word)
        last[word[len(word) - tail - half:]].append(word)
    for some in first.values():
        if len(some) > 1:
            search(some, m, head + half, tail, under, a, b, scan_rows)
    for some in last.values():
        if len(some) > 1:
            search(some, m, head, tail + half, min(under, head + half), a, b, scan_rows)


def scan(words: list[str], m: int, head: int, under: int, a: list[str], b: list[str]) -> None:
    """Appends the pairs of a sorted list of distinct words that share their
    first ``head`` characters, are one edit apart, the longer of ``m`` characters,
    with a common prefix below ``under``."""
    if len(words) < 2:
        return
    lcp = [0, *map(partial(_common, at=head), words, words[1:])]
    far = 2
    for i in range(len(words) - 1):
        query = words[i]
        n = len(query)
        # rows[d]: edits between the first head + d characters of a word of the
        # list and the first head + d - 1, head + d, head + d + 1 of the query
        rows = [(1 if head else far, 0, 1 if n > head else far)]
        j = i + 1
        while j < len(words):
            word = words[j]
            low, mid, high = rows[-1]
            d = head + len(rows) - 1
            while d < len(word) and (low < far or mid < far or high < far):
                c = word[d]
                new_low = min(mid + 1, low + (query[d - 1] != c)) if 0 < d <= n else mid + 1 if d <= n else far
                new_mid = min(new_low + 1, high + 1, mid + (query[d] != c)) if d < n else far
                high = min(new_mid + 1, high + (query[d + 1] != c)) if d + 1 < n else far
                low, mid = new_low, new_mid
                rows.append((low, mid, high))
                d += 1
            if low < far or mid < far or high < far:
                off = n - len(word)          # the cell of the whole query
                if (-1 <= off <= 1 and (low, mid, high)[off + 1] == 1 and max(n, len(word)) == m
                        and _common(query, word, head) < under):
                    a.append(query)
                    b.append(word)
                following = j + 1
            else:                            # no word with this prefix is within one edit
                following = bisect_right(words, word[:d] + _LAST, j + 1)
            if following < len(words):       # rows of the prefix that both words share hold on
                shared = lcp[following] if following == j + 1 else _common(word, words[following], head)
                del rows[shared - head + 1:]
            j = following


def _common(a: str, b: str, at: int = 0) -> int:
    """Length of the common prefix of two words that share ``at`` characters."""
    n = min(len(a), len(b))
    while at < n and a[at] == b[at]:
        at += 1
    return at


def grouped(words: DataFrame, pairs: DataFrame, factor: int = FORM_FACTOR) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word of (word, n), given
    its near pairs: a word's form is its near word of largest n (ties: smallest
    in code-point order) if that is at least ``factor`` times its own n."""
    both = pairs.select(F.col("a").alias("word"), F.col("b").alias("near")).unionByName(
        pairs.select(F.col("b").alias("word"), F.col("a").alias("near")))
    near = (both.join(words.select(F.col("word").alias("near"), F.col("n").alias("near_n")), "near")
            .groupBy("word").agg(F.count(F.lit(1)).alias("n_near"),
                                 F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best")))
    is_form = -F.col("best.less") >= factor * F.col("n")
    table = stored(words.join(near, "word", "left").select(
        "word", F.when(is_form, F.col("best.near")).alias("form"), "n",
        F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
        F.when(is_form, -F.col("best.less")).alias("form_n")), "op11-forms")
    return (table.join(_roots(table), "word", "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"))


def _roots(table: DataFrame) -> DataFrame:
    """(word, root) of the words with a form. Counts grow along a chain by the
    factor, so chains are short; each round doubles the steps taken."""
    step = stored(table.filter(F.col("form").isNotNull()).select("word", F.col("form").alias("root")), "op11-roots")
    while True:
        on = step.select(F.col("word").alias("root"), F.col("root").alias("further"))
        moved = stored(step.join(on, "root", "left")
                       .select("word", F.coalesce("further", "root").alias("root"),
                               F.col("further").isNotNull().alias("moved")), "op11-roots")
        if moved.filter("moved").isEmpty():
            return moved.drop("moved")
        step = moved.drop("moved")


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = stored(counted_words(read(spark, sf_dir, "documents"), typo_modulus=TYPO_MODULUS), "op11-words")
    return grouped(words, stored(near_pairs(words), "op11-pairs"))
