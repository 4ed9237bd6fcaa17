"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree, in DataFrame operations only.

1. Each source's target is its share by weight of all words, up to a cap; the excess goes to the others.
2. A source's documents fall into blocks by a hash, and a seeded permutation orders its blocks. A target takes
   the whole source so many times, then blocks in order, then a part of one last block: exact to the word.
3. The blocks that each source is to give (its quota) are split among output shards by a binary tree whose nodes
   hold quotas by source: a node passes half of its quota units to the left, drawn without replacement, which makes
   the numbers by source multivariate-hypergeometric. A shard's part of a quota is a run of the source's block order, so
   shards draw disjoint blocks. What a document gives to the mix is the sum of what shards draw of it.
4. Within a shard, rows are ordered by a hash.

Quotas count blocks, of which a source has ``max_blocks`` at most, so steps 1 to 3 work on small tables however
many documents there are. The last, partial block is cut at a row that is found from ids and sizes; texts meet
the small table of blocks by a join and are shuffled only once, to their shards.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from visitmart.llm.common import materialize

WORD = r"[^\x20\x09-\x0D]+"


def _hash32(*parts: Column) -> Column:
    """32 bits of an MD5; any SQL engine can repeat it."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", *parts).cast("binary")), 1, 8), 16, 10).cast("long")


def _keyed(documents: DataFrame, seed: int) -> DataFrame:
    """Documents, each as one struct, with their id, a source key that orders null last, their size and their place in the source."""
    source = F.col("source").cast("string")
    name = F.coalesce(F.col("doc_id").cast("string"), F.col("text"), F.lit(""))
    return documents.select(
        F.struct(*[documents[f"`{c}`"] for c in documents.columns]).alias("__doc"), "doc_id",
        F.when(source.isNull(), F.lit("t")).otherwise(F.concat(F.lit("s"), source)).alias("__key"),
        F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("__size"),
        _hash32(name, F.lit(str(seed))).alias("__place"),
    )


def _numbered(df: DataFrame, order: list[str], sums: tuple[str, ...] = ()) -> DataFrame:
    """``df`` with ``rank``, a running number from 0 in the (total) order, and for each of ``sums`` the sum of the rows
    before, named ``before_...``. Ranges of the order are numbered on their own and shifted by what stands before
    them, so that no task sees more than its range, and one row a range."""
    ranged = materialize(df.repartitionByRange(*order).withColumn("range", F.spark_partition_id()), "ranges")
    sizes = ranged.groupBy("range").agg(F.count(F.lit(1)).alias("n"), *[F.sum(c).alias(c) for c in sums])
    earlier = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("long")
    shifts = sizes.select("range", *[F.coalesce(F.sum(c).over(earlier), zero).alias(f"shift_{c}") for c in ("n", *sums)])
    inside = Window.partitionBy("range").orderBy(*order)
    above = inside.rowsBetween(Window.unboundedPreceding, -1)
    out = ranged.join(F.broadcast(shifts), "range")  # a row for each shuffle partition
    out = out.withColumn("rank", F.row_number().over(inside) - 1 + F.col("shift_n"))
    for c in sums:
        out = out.withColumn(f"before_{c}", F.coalesce(F.sum(c).over(above), zero) + F.col(f"shift_{c}"))
    return out.drop("range", *[f"shift_{c}" for c in ("n", *sums)])


def targets(sizes: DataFrame, weights: tuple[int, ...] = (5, 2, 1), cap: int = 3, block_docs: int = 64, max_blocks: int = 512) -> DataFrame:
    """One row for each source key: its size, target, whole epochs, words of the last epoch, number of blocks.

    Sources reach their cap in the order of cap by weight, so one running sum finds how many do; the rest
    share what is left by weight.
    """
    by_key = sizes.groupBy("__key").agg(F.sum("__size").alias("__source_size"), F.count(F.lit(1)).alias("docs"))
    ranked = _numbered(by_key, ["__key"]).withColumnRenamed("rank", "place")
    ranked = ranked.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (F.col("place") % len(weights) + 1).cast("int")).cast("long"))
    ranked = ranked.withColumn("limit", F.col("__source_size") * cap).withColumn("ratio", F.col("limit") / F.col("weight"))
    ranked = materialize(_numbered(ranked, ["ratio", "place"], ("limit", "weight")), "ranked")
    words, weight = ranked.agg(F.sum("__source_size"), F.sum("weight")).first()
    shared = ranked.withColumn("left", F.lit(words) - F.col("before_limit")).withColumn("weight_left", F.lit(weight) - F.col("before_weight"))
    shared = shared.withColumn("capped", F.col("weight") * F.col("left") >= F.col("limit") * F.col("weight_left"))
    free = shared.where(~F.col("capped")).agg(F.min(F.struct("rank", "left", "weight_left"))).first()[0]
    target = F.col("limit").cast("double")
    if free is not None:
        target = F.when(F.col("capped"), target).otherwise(F.col("weight").cast("double") * F.lit(float(free["left"])) / F.lit(float(free["weight_left"])))
    shared = shared.withColumn("__target", target)
    words = F.least(F.round("__target").cast("long"), F.col("limit"))
    shared = shared.withColumn("words", words).withColumn(
        "epochs", F.when(F.col("__source_size") > 0, F.floor(F.col("words") / F.greatest("__source_size", F.lit(1)))).otherwise(0).cast("long")
    )
    return shared.select(
        "__key", "__source_size", "__target", "epochs", (F.col("words") - F.col("epochs") * F.col("__source_size")).alias("rest"),
        F.least(F.ceil(F.col("docs") / block_docs), F.lit(max_blocks)).cast("long").alias("blocks"),
    )


def _halves(quotas: DataFrame, seed: int) -> DataFrame:
    """The next level of the tree: each node's quotas, (node, __key, quota), as those of its two children. The left one gets
    half of the node's units, rounded up: the first ones in an order of the node's own. One shuffle, by node; units
    are only spelled out after it, and counted again before the next."""
    node = Window.partitionBy("node")
    unit = _units(quotas.withColumn("of", F.sum("quota").over(node)), seed)
    right = F.row_number().over(node.orderBy("order", "__key", "unit")) > F.floor((F.col("of") + 1) / 2)
    return _children(unit.withColumn("right", right))


def _units(quotas: DataFrame, seed: int) -> DataFrame:
    unit = quotas.select("node", "__key", "of", F.explode(F.sequence(F.lit(1).cast("long"), "quota")).alias("unit"))
    return unit.withColumn("order", _hash32(F.lit(f"{seed}/tree"), F.col("node").cast("string"), F.col("__key"), F.col("unit").cast("string")))


def _children(unit: DataFrame) -> DataFrame:
    counted = unit.groupBy("node", "right", "__key").agg(F.count(F.lit(1)).alias("quota"))
    return counted.select((F.col("node") * 2 + F.col("right").cast("int")).alias("node"), "__key", "quota")


def _halves_of_large(quotas: DataFrame, seed: int) -> DataFrame:
    """The same as :func:`_halves` where a node has too many units for one task: its order falls into 4,096 parts, and only
    the part that the middle lies in is looked at row by row."""
    of = quotas.groupBy("node").agg(F.sum("quota").alias("of"))
    unit = _units(quotas.join(F.broadcast(of), "node"), seed).withColumn("part", F.shiftright("order", 20))  # a row for each node
    parts = unit.groupBy("node", "of", "part").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("node").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
    left = F.floor((F.col("of") + 1) / 2)
    middle = parts.where((F.col("before") < left) & (left <= F.col("before") + F.col("n")))
    middle = middle.select("node", F.col("part").alias("middle"), (left - F.col("before")).alias("room"))
    unit = unit.join(F.broadcast(middle), "node")  # a row for each node
    inside = unit.where("part = middle").withColumn(
        "right", F.row_number().over(Window.partitionBy("node", "part").orderBy("order", "__key", "unit")) > F.col("room")
    )
    return materialize(_children(unit.where("part != middle").withColumn("right", F.expr("part > middle")).unionByName(inside)), "tree")


def split_quotas(quotas: DataFrame, shards: int, seed: int, max_units: int = 2_000_000) -> DataFrame:
    """(__key, shard_of): for each source an array with the shard of each of its quota's units, in order.

    A binary tree whose nodes hold quotas by source. The root (node 1) has all of them; node n draws half of its units
    without replacement for node 2n and leaves the rest to node 2n + 1, so that each source's part is multivariate-
    hypergeometric; a source's numbers add up to its quota exactly. The leaves are the shards. Levels whose nodes have
    more than ``max_units`` units are split by parts of the order, with the same result.
    """
    level = quotas.where("quota > 0").select(F.lit(1).alias("node"), "__key", "quota")
    total = quotas.agg(F.sum("quota")).first()[0] or 0
    for depth in range(shards.bit_length() - 1):
        level = (_halves if total >> depth <= max_units else _halves_of_large)(level, seed)
    runs = F.sort_array(F.collect_list(F.struct((F.col("node") - shards).alias("shard"), "quota")))
    spelled = F.flatten(F.transform(runs, lambda r: F.array_repeat(r["shard"], r["quota"].cast("int"))))
    return level.groupBy("__key").agg(spelled.alias("shard_of"))  # max_blocks * (cap + 1) at most


def _order() -> Column:
    """The order of a block's rows; rows that are equal in it are taken alike."""
    return F.struct(F.col("__place"), F.col("doc_id"), F.col("__size"))


def _cuts(placed: DataFrame, partial: DataFrame, small: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """For ``partial``, the one block of a source that the last epoch takes in part: at which row (``cut``, and which of its
    ``equal_rows``) the taking stops, and how many words of that row it takes. Texts don't take part, and of a
    source only one block does, and of that the window sees one part of 256."""
    found = placed.join(partial, ["__key", "__block"])
    # first the part of the block, by place, then the row within it
    part = F.shiftright((F.col("__place") * F.col("blocks")).bitwiseAND(F.lit((1 << 32) - 1)), 24)
    found = found.withColumn("part", part)
    parts = found.groupBy("__key", "extra", "part").agg(F.sum("__size").alias("words"))
    earlier = Window.partitionBy("__key").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # 256 rows
    parts = parts.withColumn("before", F.coalesce(F.sum("words").over(earlier), F.lit(0)))
    parts = parts.where("before < extra AND extra <= before + words").select("__key", "part", (F.col("extra") - F.col("before")).alias("extra"))
    found = found.drop("extra").join(small(parts), ["__key", "part"])
    found = found.groupBy("__key", "__block", "extra", "__place", "doc_id", "__size").agg(F.count(F.lit(1)).alias("equal_rows"))
    inside = Window.partitionBy("__key", "__block").orderBy("__place", "doc_id", "__size").rowsBetween(Window.unboundedPreceding, -1)
    found = found.withColumn("left", F.col("extra") - F.coalesce(F.sum(F.col("__size") * F.col("equal_rows")).over(inside), F.lit(0)))
    rank = F.ceil(F.col("left") / F.greatest("__size", F.lit(1))).cast("long")
    return found.where("left > 0 AND left <= __size * equal_rows").select(
        "__key", "__block", _order().alias("cut"), rank.alias("cut_rank"), (F.col("left") - (rank - 1) * F.col("__size")).alias("cut_words"), "equal_rows",
    )


def _extra(rank: Column) -> Column:
    """Words of a row that the last epoch takes; ``rank`` numbers rows that are equal in :func:`_order`."""
    at_cut = F.when(rank < F.col("cut_rank"), F.col("__size")).when(rank == F.col("cut_rank"), F.col("cut_words")).otherwise(F.lit(0))
    return (
        F.when(F.col("extra") >= F.col("words"), F.col("__size")).when(F.col("extra") <= 0, F.lit(0))
        .when(_order() < F.col("cut"), F.col("__size")).when(_order() == F.col("cut"), at_cut).otherwise(F.lit(0)).cast("long")
    )


def plan(
    documents: DataFrame, weights: tuple[int, ...] = (5, 2, 1), cap: int = 3, seed: int = 7, block_docs: int = 64,
    max_blocks: int = 512, words_per_shard: int = 100_000, max_shards: int = 1024, max_broadcast: int = 100_000,
) -> DataFrame:
    """(__doc, the document as a struct, so that its columns may have any names), __size, __source_size, __target, __draws (epoch, shard and words of each time the
    document is drawn by a shard), __taken (the words of its draws) and __pieces (how many tasks a shard is worth): one row
    for each document, for :func:`mixture` and :func:`draw`."""
    rows = _keyed(documents, seed)
    slim = materialize(rows.select("__key", "__size", "__place", "doc_id"), "sizes")
    by_source = materialize(targets(slim, weights, cap, block_docs, max_blocks), "targets")
    known = by_source.agg(F.count(F.lit(1)), F.sum("__source_size")).first()
    small = F.broadcast if known[0] <= max_broadcast else (lambda df: df)
    wanted = max(1, math.ceil((known[1] or 0) / words_per_shard))
    shards = min(max_shards, 1 << (wanted - 1).bit_length())
    pieces = max(1, math.ceil((known[1] or 0) / shards / 2_000_000))

    def placed(df: DataFrame, columns: list[str]) -> DataFrame:
        out = df.join(small(by_source.select("__key", "blocks", *columns)), "__key")
        return out.withColumn("__block", F.shiftright(F.col("__place") * F.col("blocks"), 32))

    blocks = placed(slim, []).groupBy("__key", "__block").agg(F.sum("__size").alias("words"))
    blocks = blocks.join(small(by_source), "__key")
    order = Window.partitionBy("__key").orderBy("order", "__block")
    blocks = blocks.withColumn("order", _hash32(F.lit(f"{seed}/blocks"), F.col("__key"), F.col("__block").cast("string")))
    blocks = blocks.withColumn("at", F.row_number().over(order)).withColumn(
        "before", F.coalesce(F.sum("words").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    )
    blocks = blocks.withColumn("count", F.count(F.lit(1)).over(Window.partitionBy("__key")))
    blocks = materialize(
        blocks.select("__key", "__block", "at", "count", "words", "epochs", F.greatest(F.col("rest") - F.col("before"), F.lit(0)).alias("extra")), "blocks"
    )
    quotas = blocks.groupBy("__key").agg((F.max("epochs") * F.max("count") + F.sum((F.col("extra") > 0).cast("long"))).alias("quota"))
    partial = blocks.where("extra > 0 AND extra < words").select("__key", "__block", "extra")
    cuts = materialize(_cuts(placed(slim, []), small(partial), small), "cuts")
    turns = blocks.join(split_quotas(quotas, shards, seed), "__key", "left").join(cuts, ["__key", "__block"], "left").select(
        "__key", "__block", "epochs", "extra", "words", "cut", "cut_words", "cut_rank",
        F.transform(
            F.sequence(F.lit(0).cast("long"), F.col("epochs")),
            lambda e: F.struct(e.alias("epoch"), F.try_element_at("shard_of", (e * F.col("count") + F.col("at")).cast("int")).alias("shard")),
        ).alias("turns"),
    )
    turns = materialize(turns, "turns")  # a row for each block
    full = placed(rows, ["__source_size", "__target"]).join(turns, ["__key", "__block"])
    full = full.withColumn("__extra", _extra(F.lit(1)))
    if cuts.where("equal_rows > 1").limit(1).count():  # repeated rows at a cut: only they need a number
        at_cut = F.col("cut").isNotNull() & (_order() == F.col("cut"))
        numbered = full.where(at_cut).withColumn("__rank", F.row_number().over(Window.partitionBy("__key").orderBy("__place")))
        full = full.where(~F.coalesce(at_cut, F.lit(False))).unionByName(numbered.withColumn("__extra", _extra(F.col("__rank"))).drop("__rank"))
    draws = F.filter(
        F.transform(
            "turns",
            lambda t: F.struct(
                t["epoch"].alias("epoch"), t["shard"].alias("shard"),
                F.when(t["epoch"] < F.col("epochs"), F.col("__size")).otherwise(F.col("__extra")).alias("words"),
            ),
        ),
        lambda d: (d["words"] > 0) & d["shard"].isNotNull(),
    )
    full = full.select("__doc", "doc_id", "__size", "__source_size", "__target", draws.alias("__draws"))
    taken = F.aggregate("__draws", F.lit(0).cast("long"), lambda a, d: a + d["words"])
    return full.select("*", taken.alias("__taken"), F.lit(pieces).alias("__pieces"))


def mixture(documents: DataFrame, **settings) -> DataFrame:
    """(doc_id, size, source_size, target, taken, shards) of each row; ``taken`` are the words that the shards draw of
    it, ``shards`` which ones do, in order of epochs.

    A null text has size 0 and is never taken. Sources go by code point, null as one of its own, last. A
    source's taken words add up to its target, rounded to a word; no row is taken more than ``cap`` times. The
    result depends on ids, sources and sizes only. Repeated rows stay, each with its own part; rows without an
    id take their place by their text. An empty table gives an empty result; other columns are not read.
    """
    p = plan(documents.select("doc_id", "text", "source"), **settings)
    return p.select(
        F.col("__doc.doc_id").alias("doc_id"), F.col("__size").alias("size"), F.col("__source_size").alias("source_size"),
        F.round("__target", 4).alias("target"), F.col("__taken").alias("taken"),
        F.array_join(F.transform("__draws", lambda d: d["shard"].cast("string")), ",").alias("shards"),
    )


def draw(documents: DataFrame, seed: int = 7, **settings) -> DataFrame:
    """The mix itself, with the columns of ``documents``: each row as often as it is taken, dealt to its
    shards and shuffled within. The document that only a part is left for (one for each source at most) is
    cut after that many words. Rows of size 0 hold no words to take."""
    p = plan(documents, seed=seed, **settings)
    taken = p.select("__doc", "__size", "__pieces", F.explode("__draws").alias("__draw"))
    text = F.col("__doc.text")
    gaps = r"(?<=[\x20\x09-\x0D])(?=[^\x20\x09-\x0D])"
    pieces = F.split(text, gaps)  # words with the blanks that follow them; what comes before the first word
    leading = F.when(text.rlike(r"^[\x20\x09-\x0D]"), 1).otherwise(0)
    part = F.array_join(F.slice(pieces, 1, (F.col("__draw.words") + leading).cast("int")), "")
    text = F.when(F.col("__draw.words") < F.col("__size"), part).otherwise(text)
    order = F.xxhash64(F.lit(seed), "__draw.epoch", "__doc.doc_id", "__doc.text")
    out = taken.select(F.col("__doc").withField("text", text).alias("__doc"), F.col("__draw.shard").alias("__shard"), order.alias("__order"), "__pieces")
    # a shard's order is uniform, so that equal pieces of it go to tasks however large a shard is
    piece = F.pmod(F.shiftright("__order", 40), F.col("__pieces"))
    dealt = out.repartition("__shard", piece).sortWithinPartitions("__shard", piece, "__order")
    return dealt.select(*[F.col("__doc").getField(c).alias(c) for c in documents.columns])


def _halving(level: int) -> str:
    """One level of the tree in SQL; a tree of fewer levels stays as it is."""
    order = "CAST('0x' || substr(md5('7/tree:' || CAST(node AS VARCHAR) || ':' || k || ':' || CAST(unit AS VARCHAR)), 1, 8) AS BIGINT)"
    return (
        f"of{level} AS (SELECT *, sum(quota) OVER (PARTITION BY node) AS whole FROM tree{level}),\n"
        f"unit{level} AS (SELECT node, k, whole, CAST(unnest(generate_series(1, quota)) AS BIGINT) AS unit FROM of{level}),\n"
        f"rank{level} AS (SELECT node, k, whole, row_number() OVER (PARTITION BY node ORDER BY {order}, k, unit) AS rank FROM unit{level}),\n"
        f"tree{level + 1} AS (SELECT CASE WHEN levels > {level} THEN node * 2 + CAST(rank > (whole + 1) // 2 AS INTEGER) ELSE node END AS node, k, "
        f"count(*) AS quota FROM rank{level}, size_of GROUP BY 1, 2),"
    )


#: The same targets, splitting tree and draws in SQL (seed 7, blocks of 64 documents, 512 at most, shards of 100,000 words, 1024 at most).
MIXTURE_SQL = r"""
WITH base AS (
  SELECT doc_id, CASE WHEN source IS NULL THEN 't' ELSE 's' || source END AS k,
         CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
         CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), text, '') || ':7'), 1, 8) AS BIGINT) AS place
  FROM documents),
src AS (SELECT k, CAST(sum(size) AS BIGINT) AS source_size, count(*) AS docs FROM base GROUP BY k),
ranked AS (SELECT *, row_number() OVER (ORDER BY k) AS rank,
                  [5, 2, 1][CAST((row_number() OVER (ORDER BY k) - 1) % 3 + 1 AS INTEGER)] AS weight FROM src),
run AS (SELECT *, 3 * source_size AS lim,
               sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER w, 0) AS lft,
               sum(weight) OVER () - coalesce(sum(weight) OVER w, 0) AS wl
        FROM ranked
        WINDOW w AS (ORDER BY 3.0 * source_size / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
free AS (SELECT lft, wl FROM run WHERE weight * lft < lim * wl ORDER BY 3.0 * source_size / weight, rank LIMIT 1),
tgt AS (SELECT r.k, r.source_size, r.docs, r.lim,
               CASE WHEN r.weight * r.lft >= r.lim * r.wl THEN CAST(r.lim AS DOUBLE)
                    ELSE CAST(r.weight AS DOUBLE) * CAST(f.lft AS DOUBLE) / CAST(f.wl AS DOUBLE) END AS target
        FROM run r LEFT JOIN free f ON true),
quota AS (SELECT *, least(CAST(round(target) AS BIGINT), CAST(lim AS BIGINT)) AS words,
                 least(CAST(ceil(docs / 64.0) AS BIGINT), 512) AS nb FROM tgt),
ep AS (SELECT *, CASE WHEN source_size > 0 THEN words // source_size ELSE 0 END AS epochs FROM quota),
doc AS (SELECT b.*, e.source_size, e.target, e.epochs, e.words - e.epochs * e.source_size AS rest,
               (b.place * e.nb) >> 32 AS block FROM base b JOIN ep e USING (k)),
blk AS (SELECT k, block, CAST(sum(size) AS BIGINT) AS words FROM doc GROUP BY ALL),
pos AS (SELECT k, block, words, row_number() OVER w AS spot, count(*) OVER (PARTITION BY k) AS n,
               coalesce(sum(words) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM blk
        WINDOW w AS (PARTITION BY k ORDER BY CAST('0x' || substr(md5('7/blocks:' || k || ':' || CAST(block AS VARCHAR)), 1, 8) AS BIGINT), block)),
turn AS (SELECT p.*, e.epochs, greatest(e.words - e.epochs * e.source_size - p.before, 0) AS extra FROM pos p JOIN ep e USING (k)),
size_of AS (SELECT least(10, CAST(ceil(log2(greatest(1, ceil(sum(source_size) / 100000.0)))) AS INTEGER)) AS levels FROM src),
tree0 AS (SELECT 1 AS node, k, CAST(max(epochs * n) + count(*) FILTER (extra > 0) AS BIGINT) AS quota FROM turn GROUP BY k),
TREE
leaf AS (SELECT k, node - (1 << levels) AS node, unnest(generate_series(1, quota)) AS copy FROM tree10, size_of),
shard AS (SELECT k, node, row_number() OVER (PARTITION BY k ORDER BY node) AS unit FROM leaf),
taken_row AS (SELECT d.*, t.spot, t.n, row_number() OVER () AS id,
               greatest(least(greatest(d.rest - t.before, 0) - coalesce(sum(d.size) OVER (
                   PARTITION BY d.k, d.block ORDER BY d.place, d.doc_id, d.size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0), d.size), 0) AS final
        FROM doc d JOIN turn t USING (k, block)),
part AS (SELECT id, k, epoch, CASE WHEN epoch < epochs THEN size ELSE final END AS words, epoch * n + spot AS unit
         FROM (SELECT *, CAST(unnest(generate_series(0, epochs)) AS BIGINT) AS epoch FROM taken_row)),
drawn AS (SELECT id, sum(words) AS taken, string_agg(CAST(node AS VARCHAR), ',' ORDER BY epoch) AS shards FROM part JOIN shard USING (k, unit) WHERE words > 0 GROUP BY id)
SELECT doc_id, size, source_size, round(target, 4) AS target, CAST(coalesce(taken, 0) AS BIGINT) AS taken, coalesce(shards, '') AS shards
FROM taken_row LEFT JOIN drawn USING (id)
""".replace("TREE", "\n".join(map(_halving, range(10))))
