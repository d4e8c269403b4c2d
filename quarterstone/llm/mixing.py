"""Mixing sources to target weights with exact quotas, DataFrame and SQL functions only.

Each source's documents form a stream of words in a seeded permutation of the documents; the mix
takes the stream's first words up to the source's target, going round again where the target exceeds
the source. The taken words are cut into blocks of equal length, and a splitting tree deals the
blocks out to output shards: at each node the exact block quotas of all sources are split in two by a
multivariate hypergeometric draw (blocks leave the urn one at a time without replacement), halves are
split again, down to single shards. A source's blocks are then permuted and dealt to the shards in
turn by those quotas, so shards hold disjoint blocks; inside a shard the order is shuffled locally.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarterstone.llm.common import WORD, stored

WEIGHTS = 5, 2, 1
MOST_TIMES = 3
SHARDS = 64  # a power of two
BLOCKS = 4096  # blocks of the whole mix, about
PARTS_BITS = 4  # a shard lies in 2 ** PARTS_BITS parts
CHUNK = 256  # documents whose running sum is taken together, at least
SEED = 4
OWN = "source", "size", "_key"
RESULT = "source_size", "target", "taken", "draws"


def sized(docs: DataFrame) -> DataFrame:
    """The documents with ``size``, the number of words, and a key of their content."""
    return (docs.withColumn("size", F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("bigint"))
            .withColumn("_key", F.xxhash64("doc_id", "source", "text")))


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, times: int = MOST_TIMES) -> DataFrame:
    """(source, n, source_size) with number, weight and target of each source.

    Sources in code point order, null last, take the weights in turn. A target is the lesser of
    ``times`` the source's size and level * weight, with the one level at which targets sum to all
    sizes: resharing what is above a cap by weight, until none is, ends there. With the sources in
    the order of the level that caps them, the level is the largest of what the sources from each on
    would get if all before were capped.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    by_level = Window.orderBy("caps_at", "number").rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    cap = F.col("source_size") * times
    before = [F.coalesce(F.sum(c).over(by_level), F.lit(0)) for c in ("cap", "weight")]
    return (sizes.withColumn("number", F.row_number().over(by_name) - 1)
            .withColumn("weight", F.element_at(F.lit(list(weights)), F.pmod("number", F.lit(len(weights))) + 1))
            .withColumn("cap", cap).withColumn("caps_at", cap / F.col("weight"))
            .withColumn("level", (F.sum("source_size").over(every) - before[0]) / (F.sum("weight").over(every) - before[1]))
            .withColumn("level", F.max("level").over(every))
            .withColumn("target", F.least(F.col("cap").cast("double"), F.col("level") * F.col("weight")))
            .drop("cap", "caps_at", "level"))


def split_quotas(quotas: DataFrame, shards: int, seed: int) -> DataFrame:
    """(shard, quotas) from the one row ``quotas`` (an array of block counts by source).

    A node's left half gets its share of the node's blocks, source by source: for every block in the
    urn, it goes left with probability (left places free) / (blocks remaining), by a hash of the
    node and the block's turn. That is the multivariate hypergeometric draw, exactly, in as many
    steps as there are blocks.
    """
    nodes = quotas.select(F.lit(0).cast("bigint").alias("node"), "quotas")
    width = shards
    while width > 1:
        step = f"""aggregate(array_repeat(0, cast(k as int)), element_at(s, -1), (t, x) -> named_struct(
                     'n', t.n - 1,
                     'm', t.m - if((xxhash64({seed}, {width}, node, t.j) & 9007199254740991) / 9007199254740992D * t.n < t.m, 1L, 0L),
                     'j', t.j + 1,
                     'left', t.left + if((xxhash64({seed}, {width}, node, t.j) & 9007199254740991) / 9007199254740992D * t.n < t.m, 1L, 0L)),
                   t -> t)"""
        total = "aggregate(quotas, 0L, (a, k) -> a + k)"
        nodes = (nodes
                 .withColumn("steps", F.expr(f"""aggregate(quotas,
                     array(named_struct('n', {total}, 'm', {total} div 2, 'j', 0L, 'left', 0L)),
                     (s, k) -> concat(s, array({step})))"""))
                 # a source's own count is what it added
                 .withColumn("left", F.expr("transform(slice(steps, 2, size(quotas)), (s, i) -> s.left - steps[i].left)"))
                 .withColumn("child", F.explode(F.expr(
                     "array(named_struct('node', 2 * node, 'quotas', left),"
                     " named_struct('node', 2 * node + 1, 'quotas', zip_with(quotas, left, (a, b) -> a - b)))")))
                 .select("child.node", "child.quotas"))
        width //= 2
    return nodes.withColumnRenamed("node", "shard")


def plan(sizes: DataFrame, weights: tuple[int, ...], times: int, shards: int, blocks: int, seed: int) -> DataFrame:
    """One row per source: source, number, n, source_size, target, words (to take, a whole number),
    block_words, and shard_of, the shard of each of its blocks."""
    every = Window.partitionBy()
    sources = stored(
        targets(sizes, weights, times)
        .withColumn("words", F.least(F.floor(F.col("target") + 0.5), F.col("source_size") * times).cast("bigint"))
        .withColumn("block_words", F.greatest(F.lit(1), F.ceil(F.sum("words").over(every) / blocks)).cast("bigint"))
        .withColumn("quota", F.expr("(words + block_words - 1) div block_words")), "sources")
    quotas = sources.agg(F.transform(F.sort_array(F.collect_list(F.struct("number", "quota"))), lambda x: x["quota"]).alias("quotas"))
    dealt = (split_quotas(quotas, shards, seed).select("shard", F.posexplode("quotas").alias("number", "times"))
             .groupBy("number").agg(F.sort_array(F.collect_list(F.struct("shard", "times"))).alias("dealt")))
    permuted = f"array_sort(transform(if(quota > 0, sequence(0L, quota - 1), array()), b -> named_struct('h', xxhash64({seed}, 99, number, b), 'b', b)))"
    return (sources.join(dealt, "number")
            .withColumn("slots", F.expr("flatten(transform(dealt, d -> array_repeat(cast(d.shard as int), cast(d.times as int))))"))
            .withColumn("shard_of", F.expr(f"transform(array_sort(zip_with({permuted}, slots, (p, s) -> named_struct('b', p.b, 's', s))), x -> x.s)"))
            .drop("dealt", "slots", "quota", "weight"))


def mix(rows: DataFrame, weights: tuple[int, ...] = WEIGHTS, times: int = MOST_TIMES, shards: int = SHARDS,
        blocks: int = BLOCKS, seed: int = SEED) -> DataFrame:
    """Every row of ``rows`` (made by ``sized``) with source_size, target, taken (words the mix takes
    from it, repeats counted) and draws: array of (round, block, shard, first_word, words).

    A null source is a source of its own; rows without words, and all rows of an empty table, are
    drawn by nobody. A row that repeats another is drawn on its own. A document is drawn at most
    ``times`` times; a source's taken words sum to its target, rounded. The same rows and seed give
    the same mix whatever the partitioning. Running sums are taken over chunks of a source, so a
    source of any share of the rows is spread over tasks. Given columns stay whatever their names, but for
    those of the result, which are replaced.
    """
    given = rows.columns
    # other columns travel as one, so that no name meets one used here
    rows = rows.select("source", "size", "_key", F.struct(F.lit(0).alias("_"), *[F.col(f"`{c}`") for c in given if c not in OWN]).alias("_row"))
    sizes = rows.groupBy("source").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("source_size"))
    sources = stored(plan(sizes, weights, times, shards, blocks, seed)
                     .withColumn("chunks", F.ceil(F.col("n") / F.greatest(F.lit(float(CHUNK)), F.sqrt("n"))).cast("bigint")), "mix")
    own = sources.withColumnRenamed("source", "_source").drop("n")
    placed = (rows.join(own, F.equal_null(F.col("source"), F.col("_source"))).drop("_source")
              .withColumn("_order", F.xxhash64(F.lit(seed), "_key"))
              .withColumn("_chunk", F.expr("shiftright((_order & 2147483647L) * chunks, 31)")))
    before = Window.partitionBy("number").orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    chunks = stored(placed.groupBy("number", "_chunk").agg(F.sum("size").alias("words"))
                    .select("number", "_chunk", F.coalesce(F.sum("words").over(before), F.lit(0)).alias("_earlier")), "chunks")
    inside = (Window.partitionBy("number", "_chunk").orderBy(F.expr("_order & 2147483647L"), "_order", "_key", "size")
              .rowsBetween(Window.unboundedPreceding, -1))
    draw = """flatten(transform(sequence(0L, {last}L), e -> transform(
        if(size > 0 and e * source_size + _start < words,
           sequence((e * source_size + _start) div block_words,
                    (least(e * source_size + _start + size, words) - 1) div block_words),
           array()),
        b -> named_struct('round', e, 'block', b, 'shard', shard_of[cast(b as int)],
          'first_word', greatest(e * source_size + _start, b * block_words) - e * source_size - _start,
          'words', least(e * source_size + _start + size, words, (b + 1) * block_words)
                   - greatest(e * source_size + _start, b * block_words)))))""".format(last=times - 1)
    return (placed.join(chunks, ["number", "_chunk"])
            .withColumn("_start", F.col("_earlier") + F.coalesce(F.sum("size").over(inside), F.lit(0)))
            .withColumn("draws", F.expr(draw))
            .withColumn("taken", F.expr("aggregate(draws, 0L, (a, d) -> a + d.words)"))
            .select(*[F.col(c) if c in OWN else F.col("_row")[c].alias(c) for c in given if c not in RESULT], *RESULT))


def _order_key(seed: int, shard: Column, block: Column, round_: Column, first_word: Column) -> Column:
    """The place of a piece in its shard: a hash, so that a shard is in random order."""
    return F.xxhash64(F.lit(seed), F.lit(7), shard, block, round_, F.col("_key"), first_word)


def _dealt(rows: DataFrame, *ties: str) -> DataFrame:
    """Rows with shard and order_key, put together by shard and sorted by order_key. A shard lies in several
    tasks, by ranges of the key, as it grows with the mix."""
    return (rows.repartition("shard", F.shiftright("order_key", 64 - PARTS_BITS)).sortWithinPartitions("shard", "order_key", *ties))


def drawn_documents(mixed: DataFrame, columns: list[str], seed: int = SEED) -> DataFrame:
    """The mixed documents: the columns ``columns`` once for each round that draws from a document, dealt out by the
    shard of its first words and shuffled inside each shard. A document of which a round takes only the first
    words (at most one for each source) has its text cut after them, words joined by one space."""
    of_round = "filter(draws, d -> d.round = r)"
    rounds = mixed.select(*columns, "size", "_key", F.explode(F.expr(
        f"""filter(transform(array_distinct(transform(draws, d -> d.round)), r -> named_struct('round', r,
            'words', aggregate({of_round}, 0L, (a, d) -> a + d.words), 'first', element_at({of_round}, 1))), r -> r.words > 0)""")).alias("_round"))
    first = F.col("_round.first")
    rounds = (rounds.withColumn("shard", first["shard"])
              .withColumn("order_key", _order_key(seed, first["shard"], first["block"], first["round"], first["first_word"])))
    cut = F.array_join(F.slice(F.regexp_extract_all("text", F.lit(WORD), F.lit(0)), 1, F.col("_round.words").cast("int")), " ")
    whole = F.col("_round.words") >= F.col("size")
    out = rounds.withColumn("text", F.when(whole, F.col("text")).otherwise(cut))
    if "n_chars" in columns:
        out = out.withColumn("n_chars", F.when(whole, F.col("n_chars")).otherwise(F.length("text").cast("bigint")))
    return _dealt(out.select(*columns, "shard", "order_key")).select(*columns)


def shard_rows(mixed: DataFrame, seed: int = SEED, keep: tuple[str, ...] = ("doc_id", "source")) -> DataFrame:
    """The drawn pieces, dealt out by shard and shuffled inside each: shard, the columns ``keep``, round,
    block, first_word, words, and the order key that sorts a shard."""
    pieces = mixed.select(*keep, "_key", F.explode("draws").alias("d")).select(*keep, "_key", "d.*")
    return _dealt(pieces.withColumn("order_key", _order_key(seed, F.col("shard"), F.col("block"), F.col("round"), F.col("first_word"))).drop("_key"),
                  *keep[:1], "first_word")


def taken_by_shards(mixed: DataFrame, row: str, seed: int = SEED) -> DataFrame:
    """Every row of ``mixed`` with ``taken`` as the words of its pieces in the shards; ``row`` numbers the rows."""
    pieces = shard_rows(mixed, seed, (row,)).groupBy(row).agg(F.sum("words").alias("_dealt"))
    return mixed.join(pieces, row, "left").withColumn("taken", F.coalesce("_dealt", F.lit(0)).cast("bigint")).drop("_dealt")
