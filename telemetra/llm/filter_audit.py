"""How filters interact: what each one removes alone, after others and in every order.

Four filters look at a text by itself; the fifth removes later copies, found by an
existential self-join (hash, exact text, smaller doc_id). The failing ids of all filters
are united into one bit combination a document, and only the counts of combinations are
carried through the orders: what a filter removes depends on the set of filters before it,
not on their order, so sixteen sets a filter give all 120 orders.
"""

from __future__ import annotations

from itertools import combinations as subsets
from itertools import permutations
from math import factorial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from telemetra.llm.common import map_slices, power_of_two, texts_of
from telemetra.session import materialize

LETTERS = "ABCDE"
COPY_BIT = 1 << LETTERS.index("E")
UPPER = bytes(range(65, 91))
SYMBOLS = b"#$%&*|"
#: Second and later bytes of a UTF-8 character.
CONTINUED = bytes(range(0x80, 0xC0))
#: Groups of equal hashes above this size are salted; it rises with the table, so that at
#: most ``HOT_HASHES`` hashes are hot and their list is small enough to broadcast.
HOT, HOT_HASHES = 200, 10_000
#: Bits of the filter that keeps texts without any copy out of the join (2 MB).
FILTER_BITS = 1 << 24


def text_bits(text: bytes) -> int:
    """The filters A to D that a text fails, as bits 0 to 3."""
    words = text.split()
    short = len(words) < 200
    repeated = 100 * len(set(words)) < 50 * len(words)
    upper = len(text) - len(text.translate(None, UPPER))
    loud = 100 * upper > 2 * len(text.translate(None, CONTINUED))
    marked = len(text.translate(None, SYMBOLS)) < len(text)
    return short | repeated << 1 | loud << 2 | marked << 3


def _rows(docs: DataFrame) -> DataFrame:
    text = F.coalesce(docs["text"].cast("string"), F.lit(""))
    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), F.xxhash64(text).alias("h"),
                       F.coalesce(docs["source"].cast("string"), F.lit("")).alias("part"), text.alias("text"))


def text_failures(docs: DataFrame) -> DataFrame:
    """(doc_id, h, part, bits): hash of the text, part, and the filters A to D it fails."""
    def run(batch: pa.RecordBatch) -> list[pa.Array]:
        bits = np.fromiter(map(text_bits, texts_of(batch)), np.int32, batch.num_rows)
        return [batch.column(0), batch.column(1), batch.column(2), pa.array(bits)]
    return map_slices(_rows(docs), run, "doc_id long, h long, part string, bits int")


def _with_copies(rows: DataFrame, groups: DataFrame) -> DataFrame:
    """``rows`` whose hash may be in ``groups``: a bitmap of fixed size, built and looked up by joins."""
    bits = power_of_two(16 * groups.count(), 1 << 12, FILTER_BITS)
    word = lambda: F.shiftright(F.col("h").bitwiseAND(F.lit(bits - 1)), 6)
    bit = F.expr("shiftleft(1L, cast(h & 63 AS INT))")
    words = groups.groupBy(word().alias("word")).agg(F.bit_or(bit).alias("ones"))
    return rows.withColumn("word", word()).join(F.broadcast(words), "word").where(F.col("ones").bitwiseAND(bit) != 0).drop("word", "ones")


def later_copies(docs: DataFrame, hashes: DataFrame) -> DataFrame:
    """(doc_id, h, part) of the rows whose whole text a smaller doc_id has too.

    ``hashes`` are the text hashes of ``docs`` (column ``h``). Only texts whose hash occurs
    twice travel. The right side of the semi-join holds one row for each distinct text, its
    smallest doc_id; rows of hot hashes are dealt over salts and meet that row once a salt.
    """
    total = hashes.count()
    groups = materialize(hashes.groupBy("h").agg(F.count("*").alias("n")).where("n > 1"), "copies")
    cut = max(HOT, total // HOT_HASHES)
    hot = groups.where(F.col("n") > cut).select("h", F.ceil(F.col("n") / cut).cast("int").alias("salts"))
    rows = _with_copies(_rows(docs).where("doc_id IS NOT NULL"), groups)
    salted = lambda df: df.join(F.broadcast(hot), "h", "left").withColumn("salts", F.coalesce("salts", F.lit(1)))
    left = salted(rows).withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.col("salts")).cast("int"))
    right = salted(rows.groupBy("h", "text").agg(F.min("doc_id").alias("first")))
    right = right.select("h", "text", "first", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"))
    same = (left["h"] == right["h"]) & (left["salt"] == right["salt"]) & (left["text"] == right["text"])
    return left.join(right, same & (right["first"] < left["doc_id"]), "left_semi").select("doc_id", "h", "part")


def combinations(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, bits, good, toxic, docs): documents of each part by the set of filters that they fail.

    ``docs`` has ``doc_id``, ``text`` and ``source``, ``labels`` has ``doc_id``, ``quality``
    and ``toxic``. Null texts are empty, null sources the empty part. A row without a doc_id
    is no copy and has no label, but is counted. Rows that share a doc_id are each judged by
    their own text; repeated rows count each, and none is the other's copy. A doc_id with
    several labels is good or toxic if one of them says so. Other columns are not read; an
    empty table gives no rows.
    """
    found = materialize(text_failures(docs), "failures")
    copies = later_copies(docs, found.select("h"))
    each = found.select("doc_id", "h", "part", "bits", F.lit(1).cast("long").alias("n")).union(
        copies.select("doc_id", "h", "part", F.lit(COPY_BIT), F.lit(0).cast("long")))
    each = each.groupBy("doc_id", "h", "part").agg(F.bit_or("bits").alias("bits"), F.sum("n").alias("n"))
    is_one = lambda c: F.max(F.coalesce(F.col(c) == 1, F.lit(False)))
    marks = labels.select(F.col("doc_id").cast("long").alias("doc_id"), "quality", "toxic").groupBy("doc_id").agg(
        is_one("quality").alias("good"), is_one("toxic").alias("toxic"))
    marked = each.join(marks, "doc_id", "left")
    return marked.groupBy("part", "bits", F.coalesce("good", F.lit(False)).alias("good"),
                          F.coalesce("toxic", F.lit(False)).alias("toxic")).agg(F.sum("n").alias("docs"))


def interactions(combos: DataFrame, letters: str = LETTERS) -> DataFrame:
    """Counts of every filter at every step of every order, by part.

    ``combos`` are counts by bit set (bit i: fails filter ``letters[i]``). Returns part,
    filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost and
    shapley, the filter's ``removed`` summed over all orders. A part with a document has all
    rows, zeros included.
    """
    k = len(letters)
    cases = [(i, sum(1 << j for j in before), factorial(r) * factorial(k - 1 - r))
             for i in range(k) for r in range(k) for before in subsets([j for j in range(k) if j != i], r)]
    case = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(b).alias("before"), F.lit(w).cast("long").alias("orders")) for i, b, w in cases]))
    rows = combos.withColumn("case", case).select("*", "case.*")
    one = F.expr("shiftleft(1, i)")
    fails, earlier = F.col("bits").bitwiseAND(one) != 0, F.col("bits").bitwiseAND(F.col("before")) != 0
    count = lambda what: F.sum(F.when(what, F.col("docs")).otherwise(F.lit(0)).cast("long"))
    sums = rows.groupBy("part", "i", "before", "orders").agg(
        count(~fails & ~earlier).alias("kept"), count(fails & ~earlier).alias("removed"), count(fails & earlier).alias("redundant"),
        count(F.col("bits") == one).alias("unique_fails"), count(fails & ~earlier & F.col("good")).alias("good_lost"),
        count(fails & ~earlier & F.col("toxic")).alias("toxic_lost"))
    sums = sums.withColumn("shapley", F.sum(F.col("removed") * F.col("orders")).over(Window.partitionBy("part", "i")))
    steps = [("".join(letters[j] for j in p), s + 1, p[s], sum(1 << j for j in p[:s])) for p in permutations(range(k)) for s in range(k)]
    orders = combos.sparkSession.createDataFrame(steps, "filter_order string, step int, i int, before int")
    return sums.join(F.broadcast(orders), ["i", "before"]).select(
        "part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The interactions of the five filters over all documents; see ``combinations`` for odd rows."""
    return interactions(combinations(docs, labels))


SQL = r"""
WITH d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text FROM documents),
w AS (SELECT doc_id, part, text, list_filter(string_split_regex(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws, min(doc_id) OVER (PARTITION BY text) AS first FROM d),
b AS (SELECT doc_id, part,
        (len(ws) < 200)::INT + 2 * (100 * len(list_distinct(ws)) < 50 * len(ws))::INT
        + 4 * (100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 2 * length(text))::INT
        + 8 * regexp_matches(text, '[#$%&*|]')::INT + 16 * coalesce(first < doc_id, FALSE)::INT AS bits FROM w),
l AS (SELECT doc_id, coalesce(bool_or(quality = 1), FALSE) AS good, coalesce(bool_or(toxic = 1), FALSE) AS toxic FROM labels GROUP BY 1),
c AS (SELECT part, bits, coalesce(good, FALSE) AS good, coalesce(toxic, FALSE) AS toxic, count(*) AS n FROM b LEFT JOIN l USING (doc_id) GROUP BY ALL),
x AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f, unnest([1, 2, 4, 8, 16]) AS m),
o AS (SELECT a.f || b.f || c.f || d.f || e.f AS filter_order, [a.m, b.m, c.m, d.m, e.m] AS ms
      FROM x a, x b, x c, x d, x e WHERE a.m + b.m + c.m + d.m + e.m = 31 AND len(list_distinct([a.m, b.m, c.m, d.m, e.m])) = 5),
s AS (SELECT filter_order, step, ms[step] AS m, coalesce(list_sum(ms[1:step - 1]), 0)::BIGINT AS before FROM o, range(1, 6) r(step)),
r AS (SELECT part, filter_order, step::INT AS step, s.m,
        coalesce(sum(n) FILTER (WHERE bits & (before | m) = 0), 0)::BIGINT AS kept,
        coalesce(sum(n) FILTER (WHERE bits & m <> 0 AND bits & before = 0), 0)::BIGINT AS removed,
        coalesce(sum(n) FILTER (WHERE bits & m <> 0 AND bits & before <> 0), 0)::BIGINT AS redundant,
        coalesce(sum(n) FILTER (WHERE bits = m), 0)::BIGINT AS unique_fails,
        coalesce(sum(n) FILTER (WHERE bits & m <> 0 AND bits & before = 0 AND good), 0)::BIGINT AS good_lost,
        coalesce(sum(n) FILTER (WHERE bits & m <> 0 AND bits & before = 0 AND toxic), 0)::BIGINT AS toxic_lost
      FROM c, s GROUP BY 1, 2, 3, 4)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       (sum(removed) OVER (PARTITION BY part, m))::BIGINT AS shapley FROM r
"""
