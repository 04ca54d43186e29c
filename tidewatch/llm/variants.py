"""Operator 13: spelling variants grouped by an edit join on asymmetric q-chunks.

Words are maximal runs of letters (``A-Z``, ``a-z``, U+00C0 to U+00FF), ``A-Z``
lower-cased; a word counts with at least ``min_length`` code points and ``min_count``
occurrences in the whole table.  Two words are near if one inserted, deleted or
replaced code point turns one into the other.

The join is asymmetric.  The longer word of a pair (either of two of one length)
contributes its two disjoint chunks, its first half and the rest.  One edit touches
at most one of them, so the other is a positional gram of the second word, at a
shift of at most one: none for the first chunk, the difference in length for the
second.  So of the positional grams of a word only those at these shifts can
meet a chunk, for chunk words of its own length and one more, and only those are
entered.  Chunks and grams meet by 64-bit hash of (length of the chunk word, chunk,
letters); what meets is compared by the letters it holds (one edit changes at
most two of them), then verified by banded edit distance.  Both tests are
conditions of the join, so it gives near pairs only, and Spark may split a hot
chunk's partition, since nothing else needs its rows together.

Counting: a task adds up its texts in a dictionary of at most ``held`` words, Spark
adds up the tasks, so the hottest word is one row a task.  A word has fewer than
60 (length + 1) near words per letter kind, so no group of near words is large.
Forms at least double the count, so chains are short; roots are followed by joins
that double their reach.

Defined cases: a null or empty text has no words; a null doc_id counts, as the
empty id where ids matter; repeated rows count as often as they stand; an empty
table gives no rows; very long texts are read whole, very long words compared in a
band; other input columns are ignored.  Ties of the form go to the smaller word.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tidewatch.llm.common import BROADCAST_ROWS, cut, few, ship, small_batches, texts

#: Letters, after ``A-Z`` is lower-cased.
LETTERS = "[a-zÀ-ÿ]+"
BATCH = 4 << 20

Edit = Callable[[int | None, dict[str, int]], dict[str, int]]


def word_counts(docs: DataFrame, *, min_length: int = 5, min_count: int = 3, held: int = 200_000,
                edit: Edit | None = None) -> DataFrame:
    """``word, n`` of all words long and frequent enough.

    ``edit(doc_id, counts)`` may change the words of a text before they are counted."""
    ship(docs.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters = re.compile(LETTERS)
        total: Counter[str] = Counter()

        def flush() -> pa.RecordBatch:
            rows = [(w, n) for w, n in total.items() if len(w) >= min_length]
            total.clear()
            return pa.RecordBatch.from_arrays([pa.array([w for w, _ in rows], pa.string()),
                                               pa.array([n for _, n in rows], pa.int64())], names=["word", "n"])

        for batch in small_batches(batches, max_bytes=BATCH):
            for i, text in zip(batch.column("doc_id").to_pylist(), texts(batch), strict=True):
                low = text.encode("utf-8").lower().decode("utf-8")   # changes A-Z only
                own = Counter(letters.findall(low) if len(low) < BATCH else (m.group() for m in letters.finditer(low)))
                total.update(edit(i, own) if edit else own)
                if len(total) > held:
                    yield flush()
        yield flush()

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text") \
        .mapInArrow(count, "word string, n long") \
        .groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


def _letters(word: Column) -> Column:
    """64 bits, of one or more letters each: which letters the word holds."""
    bit = lambda c: F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(F.ascii(c), F.lit(64)))
    return F.aggregate(F.split(word, ""), F.lit(0).cast("long"), lambda m, c: m.bitwiseOR(bit(c)))


def chunks(words: DataFrame) -> DataFrame:
    """The two chunk rows of every word, to meet ``grams`` by ``key``."""
    size = F.length("word")
    half = F.floor(size / 2).cast("int")
    return words.select("word", "n", "mask", size.alias("size"), F.explode(F.array(
        F.xxhash64(size, F.lit(1), F.substr("word", F.lit(1), half)),
        F.xxhash64(size, F.lit(2), F.substr("word", half + 1, size)))).alias("key"))


def grams(words: DataFrame) -> DataFrame:
    """The positional grams of every word that a chunk of a word of ``size`` or
    ``size + 1`` code points can equal within the shift their lengths allow."""
    size = F.length("word")
    keys = []
    for more in (0, 1):
        whole = size + more                                # of the chunk word
        half = F.floor(whole / 2).cast("int")
        keys.append(F.xxhash64(whole, F.lit(1), F.substr("word", F.lit(1), half)))
        keys.append(F.xxhash64(whole, F.lit(2), F.substr("word", half + 1 - more, whole)))
    return words.select("word", "n", "mask", size.alias("size"), F.explode(F.array(*keys)).alias("key"))


def near_pairs(words: DataFrame) -> DataFrame:
    """``a, b, n_a, n_b``: all pairs of near words, each pair in both directions."""
    words = words.withColumn("mask", _letters(F.col("word")))
    x = chunks(words).select(*[F.col(c).alias(f"{c}_x") for c in ("word", "n", "mask", "size")], "key")
    y = grams(words).select(*[F.col(c).alias(f"{c}_y") for c in ("word", "n", "mask", "size")], "key")
    once = (F.col("size_x") > F.col("size_y")) | (F.col("word_x") < F.col("word_y"))
    alike = F.bit_count(F.col("mask_x").bitwiseXOR(F.col("mask_y"))) <= 2
    met = x.hint("merge").join(y, (x["key"] == y["key"]) & once & (F.col("size_x") >= F.col("size_y")) & alike
                               & (F.levenshtein("word_x", "word_y", 1) == 1)) \
        .groupBy("word_x", "word_y").agg(F.min("n_x").alias("n_x"), F.min("n_y").alias("n_y"))
    return met.select(F.explode(F.array(
        F.struct(F.col("word_x").alias("a"), F.col("word_y").alias("b"), F.col("n_x").alias("n_a"), F.col("n_y").alias("n_b")),
        F.struct(F.col("word_y").alias("a"), F.col("word_x").alias("b"), F.col("n_y").alias("n_a"), F.col("n_x").alias("n_b")),
    )).alias("p")).select("p.*")


def roots(forms: DataFrame, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """``word, root``: the end of every chain of ``forms(word, form)``."""
    ends = cut(forms.select("word", F.col("form").alias("root")))
    while True:
        ahead = ends.select(F.col("word").alias("root"), F.col("root").alias("further"))
        new = cut(ends.join(few(ahead, broadcast_rows), "root", "left")
                  .select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")))
        if not new.where("moved").limit(1).count():
            return new.select("word", "root")
        ends = new.select("word", "root")


def group(docs: DataFrame, *, min_length: int = 5, min_count: int = 3, ratio: int = 2, held: int = 200_000,
          broadcast_rows: int = BROADCAST_ROWS, edit: Edit | None = None) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of every word.

    ``form`` is the near word of largest count, if that is ``ratio`` times the word's
    or more; ``root`` is where the forms from ``word`` on lead to."""
    words = cut(word_counts(docs, min_length=min_length, min_count=min_count, held=held, edit=edit))
    near = near_pairs(words).groupBy("a").agg(
        F.count("*").alias("n_near"), F.min("n_a").alias("n"),
        F.min(F.struct((-F.col("n_b")).alias("less"), F.col("b").alias("form"))).alias("top"))
    rises = -F.col("top.less") >= ratio * F.col("n")
    near = cut(near.select(F.col("a").alias("word"), "n_near", F.when(rises, F.col("top.form")).alias("form"),
                           F.when(rises, -F.col("top.less")).alias("form_n")))
    led = roots(near.where("form IS NOT NULL").select("word", "form"), broadcast_rows)
    return words.join(few(near, broadcast_rows), "word", "left").join(few(led, broadcast_rows), "word", "left") \
        .select("word", "form", F.coalesce("root", "word").alias("root"), "n",
                F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "form_n")
