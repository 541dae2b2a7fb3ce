"""Shards by a consistent-hash ring with virtual nodes and bounded loads, in DataFrame operations only.

Every shard owns many arcs of a ring; a document belongs to the arc its doc_id hashes
into. A shard takes no more than its share: it keeps its own documents up to that, and the
surplus goes on clockwise to the next shard with room. Documents that stay are those a ring
without bounds gives the shard, so a change of the number of shards moves only what the
ring and the surplus must move.

What crosses from arc to arc is worked out on the table of arcs (shards x virtual nodes
rows, whatever the input); documents then find their shard by their rank inside their arc.
An arc is cut into cells of bounded size by a second hash, so no window grows with the data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from telemetra.session import materialize

#: Places on the ring and in an arc: 60 bits, the first 15 hex digits of an MD5.
BITS = 60
#: The ring is looked up by its first bits; each segment meets few arcs.
SEGMENT_BITS = 12
#: Documents in a cell (roughly); equal rows beyond ``CHUNK`` go to cells of their own.
CELL, CHUNK = 100_000, 50_000


def _place(text: Column) -> Column:
    return F.conv(F.left(F.md5(text), F.lit(BITS // 4)), 16, 10).cast("long")


def ring(spark: SparkSession, shards: int, nodes: int) -> DataFrame:
    """(arc, shard, low, high): arcs ``low < place <= high`` of the virtual nodes, clockwise.

    Arc 0 also has the places beyond the last node. A node on another node's place owns
    nothing. ``shards * nodes`` rows and no more.
    """
    node = spark.range(shards * nodes).select((F.col("id") % shards).cast("int").alias("shard"), F.floor(F.col("id") / shards).alias("node"))
    placed = node.select("shard", _place(F.concat_ws(":", F.lit("shard"), "shard", "node")).alias("high"))
    w = Window.orderBy("high", "shard")
    return placed.select((F.row_number().over(w) - 1).alias("arc"), "shard", F.lag("high", 1, -1).over(w).alias("low"), "high")


def _pieces(arcs: DataFrame) -> DataFrame:
    """Arcs cut at the segments of the ring: (segment, low, high, arc)."""
    beyond = arcs.agg(F.max("high").alias("low")).select(F.lit(0).alias("arc"), "low", F.lit((1 << BITS) - 1).alias("high"))
    whole = arcs.select("arc", "low", "high").union(beyond).where("low < high")
    shift = BITS - SEGMENT_BITS
    return whole.select(F.explode(F.sequence(F.shiftright(F.col("low") + 1, shift), F.shiftright("high", shift))).alias("segment"), "low", "high", "arc")


def _plan(arcs: DataFrame, counts: DataFrame, shards: int, slack: float) -> DataFrame:
    """For each arc, how many of its documents stay and where the others go.

    (arc, shard, n, base, kept, shed_before, moves): ``base`` documents of the shard are in
    earlier arcs; the first ``kept`` of the arc stay, the rest are shed and numbered on from
    ``shed_before`` around the ring; ``moves`` are the runs of those numbers by shard taken.
    The shed documents queue along the ring twice: all are taken in the second lap at the
    latest, as there is room for every document.
    """
    a = arcs.join(counts, "arc", "left").select("arc", "shard", F.coalesce("n", F.lit(0)).cast("long").alias("n"))
    total, mine = F.sum("n").over(Window.partitionBy()), Window.partitionBy("shard")
    if slack:
        cap = F.ceil(total * (1 + slack) / shards).cast("long")
    else:
        cap = F.floor(total / shards) + (F.col("shard") < F.pmod(total, F.lit(shards))).cast("long")
    before = mine.orderBy("arc").rowsBetween(Window.unboundedPreceding, -1)
    a = a.withColumns({"cap": cap, "own": F.sum("n").over(mine), "base": F.coalesce(F.sum("n").over(before), F.lit(0))})
    a = a.withColumn("kept", F.greatest(F.lit(0), F.least("n", F.col("cap") - F.col("base"))))
    a = a.withColumn("shed", F.col("n") - F.col("kept"))
    a = a.withColumn("shed_before", F.sum("shed").over(Window.orderBy("arc")) - F.col("shed"))
    one = a.agg(
        F.array_sort(F.collect_list(F.struct("arc", "shard", "n", "base", "kept", "shed", "shed_before", "cap"))).alias("arcs"),
        F.array_sort(F.collect_set(F.struct("shard", F.greatest(F.lit(0), F.col("cap") - F.col("own")).alias("room")))).alias("rooms"))
    room, waiting = "acc.rooms[x.shard]", "(acc.waiting + x.shed)"
    take = f"least({waiting}, {room})"
    start = "named_struct('waiting', 0L, 'done', 0L, 'rooms', transform(rooms, r -> r.room), 'moves', cast(array() AS array<struct<first: bigint, last: bigint, to: int, slot: bigint>>))"
    step = (f"named_struct('waiting', {waiting} - {take}, 'done', acc.done + {take}, "
            f"'rooms', if({take} > 0, transform(acc.rooms, (r, i) -> if(i = x.shard, r - {take}, r)), acc.rooms), "
            f"'moves', if({take} > 0, concat(acc.moves, array(named_struct('first', acc.done, 'last', acc.done + {take} - 1, 'to', x.shard, 'slot', x.cap - {room}))), acc.moves))")
    lap = "concat(arcs, transform(arcs, x -> named_struct('arc', x.arc, 'shard', x.shard, 'n', 0L, 'base', 0L, 'kept', 0L, 'shed', 0L, 'shed_before', 0L, 'cap', x.cap)))"
    one = one.withColumn("moves", F.expr(f"aggregate({lap}, {start}, (acc, x) -> {step}).moves"))
    own = F.expr("transform(arcs, x -> named_struct('x', x, 'moves', filter(moves, m -> x.shed > 0 AND m.first < x.shed_before + x.shed AND m.last >= x.shed_before)))")
    return one.select(F.explode(own).alias("e")).select("e.x.*", "e.moves").drop("shed", "cap")


def assign(docs: DataFrame, shards: int, nodes: int = 128, slack: float = 0.0) -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot, home_shard), one row per row of ``docs``.

    A shard takes at most ``1 + slack`` times the mean number of documents (rounded up);
    without slack every shard takes the mean, rounded up in the first shards and down in the
    rest, so that counts are at most one apart. ``slot`` counts the documents of a shard
    from 0 without a gap. ``home_shard`` is the shard by the ring alone; where it differs the
    document is surplus. ``size`` is the text's UTF-8 bytes plus 16.

    The result depends on the rows alone, not on their order or partitions. Rows that share
    a doc_id are on one arc, ordered by a hash of id, size and checksum; repeated rows are
    counted once and dealt out one after the other. A null doc_id hashes as an empty text
    and stays null; a null text has size 16 and checksum 0. Other columns are not read. An
    empty table gives no rows.
    """
    spark = docs.sparkSession
    arcs = materialize(ring(spark, shards, nodes), "ring")
    text = F.coalesce(docs["text"].cast("string"), F.lit(""))
    base = docs.select(docs["doc_id"].cast("long").alias("doc_id"), (F.octet_length(text) + 16).cast("long").alias("size"),
                       F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"))
    rows = base.groupBy("doc_id", "size", "text_crc32").agg(F.count("*").alias("n"))
    id_text = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    rows = rows.withColumn("place", _place(id_text)).withColumn("segment", F.shiftright("place", BITS - SEGMENT_BITS))
    pieces = F.broadcast(_pieces(arcs))  # shards * nodes + 2 ** SEGMENT_BITS rows at most
    rows = rows.join(pieces, (rows["segment"] == pieces["segment"]) & (rows["place"] > pieces["low"]) & (rows["place"] <= pieces["high"]))
    rows = materialize(rows.select("doc_id", "size", "text_crc32", "n", "arc"), "rows")

    plan = materialize(_plan(arcs, rows.groupBy("arc").agg(F.sum("n").alias("n")), shards, slack), "plan")
    cells = plan.withColumn("cell_bits", F.greatest(F.lit(0), F.ceil(F.log2(F.greatest(F.col("n"), F.lit(1)) / CELL))).cast("int"))
    dealt = rows.withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(n - 1) div {CHUNK}"))))
    dealt = dealt.withColumn("copies", F.least(F.lit(CHUNK), F.col("n") - F.col("chunk") * CHUNK)).drop("n")
    dealt = dealt.withColumn("order", _place(F.concat_ws("|", id_text, "size", "text_crc32", "chunk")))
    dealt = dealt.join(F.broadcast(cells), "arc").withColumn("cell", F.expr(f"shiftright(order, {BITS} - cell_bits)"))
    sizes = dealt.groupBy("arc", "cell").agg(F.sum("copies").alias("in_cell"))
    offsets = sizes.select("arc", "cell", (F.sum("in_cell").over(Window.partitionBy("arc").orderBy("cell")) - F.col("in_cell")).alias("offset"))
    w = Window.partitionBy("arc", "cell").orderBy("order", "doc_id", "size", "text_crc32", "chunk")
    ranked = dealt.join(offsets, ["arc", "cell"]).withColumn("rank", F.col("offset") + F.sum("copies").over(w) - F.col("copies"))
    each = ranked.withColumn("rank", F.explode(F.sequence(F.col("rank"), F.col("rank") + F.col("copies") - 1)))
    each = each.withColumn("number", F.col("shed_before") + F.col("rank") - F.col("kept"))
    each = each.withColumn("move", F.when(F.col("rank") >= F.col("kept"), F.expr("filter(moves, m -> number BETWEEN m.first AND m.last)[0]")))
    return each.select("doc_id", "size", "text_crc32",
                       F.coalesce("move.to", "shard").alias("shard"),
                       F.coalesce(F.col("move.slot") + F.col("number") - F.col("move.first"), F.col("base") + F.col("rank")).alias("slot"),
                       F.col("shard").alias("home_shard"))


#: The same in SQL; equal rows up to one chunk, 40 shards of 128 nodes, no slack. The queue
#: around the ring is a fold over its arcs.
SQL = r"""
WITH byte AS (SELECT list(c ORDER BY n) AS t FROM (SELECT n, list_reduce([n, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c FROM range(256) r(n))),
txt AS (SELECT row_number() OVER () AS rid, doc_id, encode(coalesce(text, '')) AS b FROM documents),
d AS (SELECT doc_id, octet_length(b)::BIGINT + 16 AS size,
        xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(regexp_extract_all(hex(b), '..'), lambda h: ('0x' || h)::BIGINT)),
            lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1])), 4294967295) AS text_crc32 FROM txt, byte),
node AS (SELECT (i % 40)::INT AS shard, ('0x' || left(md5('shard:' || (i % 40) || ':' || (i // 40)), 15))::BIGINT AS high FROM range(5120) r(i)),
ring AS (SELECT row_number() OVER (ORDER BY high, shard) - 1 AS arc, shard, high, lag(high, 1, -1) OVER (ORDER BY high, shard) AS low FROM node),
p AS (SELECT *, ('0x' || left(md5(coalesce(doc_id::VARCHAR, '')), 15))::BIGINT AS place,
        ('0x' || left(md5(concat_ws('|', coalesce(doc_id::VARCHAR, ''), size, text_crc32, 0)), 15))::BIGINT AS ord FROM d),
k AS (SELECT p.*, arc, row_number() OVER (PARTITION BY arc ORDER BY ord, doc_id, size, text_crc32) - 1 AS rank
      FROM p JOIN ring ON (place > low AND place <= high) OR (arc = 0 AND place > (SELECT max(high) FROM ring))),
a0 AS (SELECT arc, shard, coalesce(n, 0) AS n, (SELECT count(*) FROM k) AS total FROM ring LEFT JOIN (SELECT arc, count(*) AS n FROM k GROUP BY 1) USING (arc)),
a1 AS (SELECT *, total // 40 + (shard < total % 40)::BIGINT AS cap, sum(n) OVER (PARTITION BY shard)::BIGINT AS own,
         (sum(n) OVER (PARTITION BY shard ORDER BY arc) - n)::BIGINT AS base FROM a0),
a2 AS (SELECT *, greatest(0, least(n, cap - base)) AS kept FROM a1),
a AS (SELECT *, n - kept AS shed, (sum(n - kept) OVER (ORDER BY arc) - (n - kept))::BIGINT AS shed_before FROM a2),
rooms AS (SELECT list(room ORDER BY shard) AS rs FROM (SELECT DISTINCT shard, greatest(0, cap - own)::BIGINT AS room FROM a)),
laps AS (SELECT arc, shard, shed, cap FROM a UNION ALL SELECT arc + 5120, shard, 0, cap FROM a),
fold AS (SELECT list_reduce(list_prepend({'shard': -1, 'shed': 0::BIGINT, 'cap': 0::BIGINT, 'waiting': 0::BIGINT, 'done': 0::BIGINT, 'rooms': (SELECT rs FROM rooms),
           'moves': []::STRUCT(f BIGINT, l BIGINT, t INT, s BIGINT)[]},
           (SELECT list({'shard': shard, 'shed': shed::BIGINT, 'cap': cap::BIGINT, 'waiting': 0::BIGINT, 'done': 0::BIGINT, 'rooms': []::BIGINT[], 'moves': []::STRUCT(f BIGINT, l BIGINT, t INT, s BIGINT)[]} ORDER BY arc) FROM laps)),
           lambda c, x: {'shard': x.shard, 'shed': x.shed, 'cap': x.cap, 'waiting': c.waiting + x.shed - least(c.waiting + x.shed, c.rooms[x.shard + 1]),
             'done': c.done + least(c.waiting + x.shed, c.rooms[x.shard + 1]),
             'rooms': CASE WHEN least(c.waiting + x.shed, c.rooms[x.shard + 1]) > 0 THEN list_transform(c.rooms, lambda r, i: CASE WHEN i = x.shard + 1 THEN r - least(c.waiting + x.shed, r) ELSE r END) ELSE c.rooms END,
             'moves': CASE WHEN least(c.waiting + x.shed, c.rooms[x.shard + 1]) > 0 THEN list_append(c.moves, {'f': c.done, 'l': c.done + least(c.waiting + x.shed, c.rooms[x.shard + 1]) - 1, 't': x.shard, 's': x.cap - c.rooms[x.shard + 1]}) ELSE c.moves END}).moves AS ms),
m AS (SELECT unnest(ms) AS m FROM fold),
e AS (SELECT k.doc_id, size, text_crc32, a.shard, base + rank AS own_slot, CASE WHEN rank >= kept THEN shed_before + rank - kept END AS number FROM k JOIN a USING (arc))
SELECT doc_id, size, text_crc32, 'rows' AS law, coalesce(m.t, shard)::INT AS shard, coalesce(m.s + number - m.f, own_slot)::BIGINT AS slot,
       NULL::INT AS grown_shard, shard::INT AS home_shard
FROM e LEFT JOIN m ON number BETWEEN m.f AND m.l
"""
