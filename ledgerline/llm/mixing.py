"""Mixing sources to target weights by Sainte-Laguë apportionment (DataFrame functions only).

The mix holds as many words as the corpus. Each source has a target: its share by
weight, at most ``MOST_COPIES`` times its own size, what is cut off being shared
again by weight. The mix is made of blocks of equally many words; a source whose size
or target is less than ``source_blocks`` of them is dealt in blocks halved until it
has as many, down to single words, so that it gets its target too. Among the sources
of one block size, blocks that hold their targets' total go to
the sources by highest quotients ``target / (2k - 1)``, and each source's blocks go to
its shards by highest quotients of the shard sizes, so every shard has an integer
quota. A shard lays its documents end to end in a seeded order and cuts that strip
into blocks; its quota takes every block as often as it goes round, and the
remainder picks distinct blocks by a seeded permutation. A document's ``taken`` is
the number of its words in the blocks taken, with repeats.

Seats are dealt without listing all quotients: divisors on both sides of the
deciding one bound each party's seats within a few, and only those few are ranked.

Nothing depends on how rows are partitioned: shards are ranges of a hash of the id,
so one source holding a third of all rows is dealt over many shards, and sizes are
summed before they are shuffled.

Defined results: a null or blank text has size 0 and takes 0; a very long text lies
over as many blocks as it has words for; a null source is a
source of its own, listed last; documents without id order by their size and text;
fully repeated rows share out what their copies take in any order; an empty table
gives an empty table; other input columns, also ones named like results, are kept.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.columns import free_name
from ledgerline.sources.sinks import materialize

WORD = "[^ \\t-\\r]+"


@dataclass(frozen=True)
class MixSpec:
    """Settings of a mix."""

    seed: str = "mix-1"
    #: Weights of the sources in code point order, repeating.
    weights: tuple[int, ...] = (1, 2, 3)
    #: No source and no document is taken more often than this.
    most_copies: int = 3
    #: Words in a block: this part of the corpus, between 1 and ``most_block_words``.
    blocks: int = 100_000
    most_block_words: int = 512
    #: Blocks that the size and the target of a source hold at least, unless its blocks are words.
    source_blocks: int = 200
    #: Words in a shard, about; a source has at most ``FINE`` shards.
    shard_words: int = 100_000


#: Fine hash ranges of which shards are made: the first hex digits of the key. A source of 5 trillion words,
#: a third of 100 TB, has shards of 5 million words.
FINE_DIGITS = 5
FINE = 16 ** FINE_DIGITS
#: A prime above any number of blocks in a shard, so that multiples of it permute them.
PRIME = 2_147_483_647


def source_key(source: Column) -> Column:
    """A key without null that keeps all sources apart."""
    return F.coalesce(F.concat(F.lit("s"), source), F.lit("n"))


def hex_number(text: Column, digits: int) -> Column:
    return F.conv(F.substring(text, 1, digits), 16, 10).cast("long")


def apportion(parties: DataFrame, group: list[str], order: list[str], votes: str, seats: str, result: str) -> DataFrame:
    """``parties`` with their Sainte-Laguë seats: in each group, ``seats`` seats by highest ``votes / (2k - 1)``.

    Equal quotients go by ``order``. The total of a group's seats is exact.
    """
    whole = Window.partitionBy(*group)
    v, n = F.col(votes).cast("double"), F.col(seats).cast("double")
    bounded = parties.withColumns({
        "_votes": F.sum(v).over(whole), "_half": F.count(F.lit(1)).over(whole) / F.lit(2.0)})
    # With the larger divisor at most `seats` seats are dealt, with the smaller one at least as many.
    fewest = F.when(n > F.col("_half"), F.floor(v * (n - F.col("_half")) / F.col("_votes") + 0.5) - 1).otherwise(0)
    most = F.floor(v * (n + F.col("_half")) / F.col("_votes") + 0.5) + 1
    alive = (F.col("_votes") > 0) & (n > 0) & (v > 0)
    bounded = bounded.withColumns({
        "_fewest": F.when(alive, F.greatest(F.lit(0), fewest)).otherwise(0).cast("long"),
        "_most": F.when(alive, most).otherwise(0).cast("long")})
    bounded = bounded.withColumn("_left", F.col(seats) - F.sum("_fewest").over(whole))
    tried = bounded.withColumn("_seat", F.explode_outer(
        F.when(F.col("_most") > F.col("_fewest"), F.sequence(F.col("_fewest") + 1, F.col("_most")))))
    ranked = tried.withColumn("_rank", F.row_number().over(
        whole.orderBy(F.desc_nulls_last(F.col(votes) / (2 * F.col("_seat") - 1)), *order, "_seat")))
    won = ((F.col("_rank") <= F.col("_left")) & F.col("_seat").isNotNull()).cast("long")
    return ranked.groupBy(*parties.columns).agg((F.max("_fewest") + F.sum(won)).alias(result))


def source_targets(sizes: DataFrame, spec: MixSpec) -> DataFrame:
    """(key, source, source_size) with the target of each source.

    Sources whose cap is below their share are the first ones by ``cap / weight``;
    one pass over that order finds them: a source is capped when its cap is less than
    its weight's share of what the sources before it leave.
    """
    everything = Window.partitionBy(F.lit(0))  # one row per source
    place = F.row_number().over(everything.orderBy(F.asc_nulls_last("source"))) - 1
    weight = F.element_at(F.array(*map(F.lit, spec.weights)), (place % len(spec.weights) + 1).cast("int")).cast("decimal(38,0)")
    cap = (F.col("source_size") * spec.most_copies).cast("decimal(38,0)")
    ranked = sizes.withColumns({"place": place, "weight": weight, "cap": cap})
    before = everything.orderBy(F.col("cap") / F.col("weight"), "place").rowsBetween(Window.unboundedPreceding, -1)
    total = lambda c: F.sum(c).over(everything).cast("decimal(38,0)")
    earlier = lambda c: F.coalesce(F.sum(c).over(before), F.lit(0)).cast("decimal(38,0)")
    ranked = ranked.withColumns({
        "all_words": total(F.col("source_size")), "all_weights": total(F.col("weight")),
        "cap_before": earlier(F.col("cap")), "weight_before": earlier(F.col("weight"))})
    capped = (F.col("cap").cast("double") * (F.col("all_weights") - F.col("weight_before")).cast("double")
              < F.col("weight").cast("double") * (F.col("all_words") - F.col("cap_before")).cast("double"))
    ranked = ranked.withColumn("capped", capped)
    left = F.col("all_words") - total(F.when(F.col("capped"), F.col("cap")).otherwise(0))
    weights_left = F.col("all_weights") - total(F.when(F.col("capped"), F.col("weight")).otherwise(0))
    share = F.col("weight").cast("double") * left.cast("double") / weights_left.cast("double")
    return ranked.withColumn("target", F.when(F.col("capped"), F.col("cap").cast("double")).otherwise(share)).select(
        "key", "source", "place", "source_size", "target", F.col("all_words").cast("long").alias("all_words"))


def mix_sources(df: DataFrame, text_col: str = "text", source_col: str = "source", id_col: str = "doc_id",
                spec: MixSpec | None = None, result: str = "mix") -> DataFrame:
    """``df`` with a struct (size, source_size, target, taken) for each document."""
    spec = spec or MixSpec()
    text, source, id_ = (F.col(f"`{c}`") for c in (text_col, source_col, id_col))
    names = {n: free_name(df, f"_mix_{n}") for n in ("size", "key", "order", "tie", "shard")}
    size, key, order, tie, shard = names.values()
    sized = df.withColumns({
        size: F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long"), key: source_key(source),
        order: F.md5(F.concat_ws(":", F.lit(spec.seed), id_.cast("string"))), tie: F.xxhash64(text)})

    fine = materialize(sized.groupBy(F.col(key).alias("key"), source.alias("source"), hex_number(F.col(order), FINE_DIGITS).alias("fine"))
                       .agg(F.sum(size).alias("words")), "mix-sizes")
    sources = source_targets(fine.groupBy("key", "source").agg(F.sum("words").alias("source_size")), spec)
    block = F.greatest(F.lit(1), F.least(F.lit(spec.most_block_words), F.floor(F.col("all_words") / spec.blocks))).cast("long")
    # Halved blocks: by the least power of two at which the source's lesser side holds enough of them.
    lesser = F.greatest(F.lit(1.0), F.least(F.col("source_size").cast("double"), F.col("target")))
    halvings = F.ceil(F.log2(F.greatest(F.lit(1.0), spec.source_blocks * F.col("most_block") / lesser)))
    sources = sources.withColumn("most_block", block).withColumn(
        "block", F.greatest(F.lit(1), F.floor(F.col("most_block") / F.pow(F.lit(2.0), halvings))).cast("long"))
    whole = F.col("block") == F.col("most_block")
    of_all = Window.partitionBy(F.lit(0)).orderBy("place").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    of_block = Window.partitionBy("block").orderBy("place").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    words = F.when(whole, F.col("all_words") - F.sum(F.when(whole, 0.0).otherwise(F.col("target"))).over(of_all)).otherwise(
        F.sum("target").over(of_block))
    sources = sources.withColumn("all_blocks", F.round(words / F.col("block")).cast("long"))
    shards = F.greatest(F.lit(1), F.least(F.lit(FINE), F.ceil(F.col("source_size") / spec.shard_words))).cast("long")
    sources = materialize(apportion(sources, ["block"], ["place"], "target", "all_blocks", "blocks").withColumn("shards", shards),
                          "mix-sources")

    shard_of = lambda hashed: F.floor(hashed * F.col("shards") / FINE).cast("long")
    quotas = (fine.join(sources.select("key", "shards", "blocks", "block"), "key")
              .groupBy("key", shard_of(F.col("fine")).alias("shard"), "blocks", "block").agg(F.sum("words").alias("shard_words")))
    quotas = apportion(quotas, ["key"], ["shard"], "shard_words", "blocks", "seats")
    n_blocks = F.ceil(F.col("shard_words") / F.col("block")).cast("long")
    quotas = quotas.withColumn("n_blocks", n_blocks).withColumn("quota", F.least("seats", spec.most_copies * F.col("n_blocks")))
    quotas = materialize(quotas.select(
        F.col("key").alias(key), F.col("shard").alias(shard), "n_blocks", "quota",
        hex_number(F.md5(F.concat_ws(":", F.lit(spec.seed), "key", F.col("shard").cast("string"))), 8).alias("turn")), "mix-quotas")

    by_source = sources.select(F.col("key").alias(key), "source_size", "target", "block", "shards")
    wanted = free_name(df, result)
    facts, first = free_name(df, "_mix_facts"), free_name(df, "_mix_first")
    dealt = sized.join(by_source.select(key, F.struct("source_size", "target", "block", "shards").alias(facts)), key)
    dealt = dealt.withColumn(shard, F.floor(hex_number(F.col(order), FINE_DIGITS) * F.col(facts)["shards"] / FINE).cast("long"))
    strip = Window.partitionBy(key, shard).orderBy(order, size, tie).rowsBetween(Window.unboundedPreceding, -1)
    dealt = dealt.withColumn(first, F.coalesce(F.sum(size).over(strip), F.lit(0)))
    quota = free_name(df, "_mix_quota")
    dealt = dealt.join(quotas.select(key, shard, F.struct("n_blocks", "quota", "turn").alias(quota)), [key, shard])
    q, f = F.col(quota), F.col(facts)
    return dealt.select(*(F.col(f"`{c}`") for c in df.columns), F.struct(
        F.col(size).alias("size"), f["source_size"].alias("source_size"), f["target"].alias("target"),
        words_taken(F.col(first), F.col(size), f["block"], q["n_blocks"], q["quota"], q["turn"]).alias("taken")).alias(wanted))


def words_taken(first: Column, size: Column, block: Column, n_blocks: Column, quota: Column, turn: Column) -> Column:
    """Words of the stretch ``[first, first + size)`` in the blocks that a quota takes."""
    rounds, rest = F.floor(quota / n_blocks).cast("long"), quota % n_blocks
    picked = lambda j: F.pmod(F.pmod(j, n_blocks) * F.lit(PRIME) + turn, n_blocks) < rest
    overlap = lambda j: F.least(first + size, (j + 1) * block) - F.greatest(first, j * block)
    blocks = F.sequence(F.floor(first / block).cast("long"), F.floor((first + size - 1) / block).cast("long"))
    partly = F.aggregate(blocks, F.lit(0).cast("long"), lambda total, j: total + F.when(picked(j), overlap(j)).otherwise(0))
    return F.when((size > 0) & (n_blocks > 0), rounds * size + partly).otherwise(0).cast("long")


def op6_source_mix(documents: DataFrame) -> DataFrame:
    """Words that the mix takes of every document."""
    out = mix_sources(documents.select("doc_id", "source", "text"))
    return out.select("doc_id", *(F.col(f"mix.{c}").alias(c) for c in ("size", "source_size", "target", "taken")), "source")


OP6_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         coalesce('s' || source, 'n') AS key, md5(concat_ws(':', 'mix-1', CAST(doc_id AS VARCHAR))) AS ord FROM documents),
hashed AS (SELECT *, ('0x' || substr(ord, 1, 5))::BIGINT AS fine FROM sized),
per_source AS (SELECT key, any_value(source) AS source, sum(size)::BIGINT AS source_size FROM hashed GROUP BY key),
ranked AS (
  SELECT *, row_number() OVER (ORDER BY source ASC NULLS LAST) - 1 AS place,
         ((row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 + 1)::DOUBLE AS weight,
         (3 * source_size)::DOUBLE AS cap FROM per_source),
summed AS (
  SELECT *, sum(source_size::DOUBLE) OVER () AS t, sum(weight) OVER () AS w,
         coalesce(sum(cap) OVER before, 0) AS cap_before, coalesce(sum(weight) OVER before, 0) AS weight_before
  FROM ranked WINDOW before AS (ORDER BY cap / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
judged AS (SELECT *, cap * (w - weight_before) < weight * (t - cap_before) AS capped FROM summed),
targets AS (
  SELECT *, CASE WHEN capped THEN cap ELSE weight * (t - sum(CASE WHEN capped THEN cap ELSE 0 END) OVER ())
                                          / (w - sum(CASE WHEN capped THEN weight ELSE 0 END) OVER ()) END AS target,
         greatest(1, least(512, floor(t / 100000)))::BIGINT AS most_block FROM judged),
halved AS (
  SELECT *, greatest(1, floor(most_block / power(2, ceil(log2(greatest(1.0, 200 * most_block
           / greatest(1.0, least(source_size::DOUBLE, target))))))))::BIGINT AS block FROM targets),
dealt AS (
  SELECT *, round(CASE WHEN block = most_block THEN t - sum(CASE WHEN block = most_block THEN 0 ELSE target END) OVER ()
                  ELSE sum(target) OVER (PARTITION BY block) END / block) AS n FROM halved),
seats AS (
  SELECT key, count(*) AS blocks FROM (
    SELECT key, row_number() OVER (PARTITION BY block ORDER BY target / (2 * k - 1) DESC, place, k) AS r, n
    FROM (SELECT *, unnest(generate_series(1, (target / block * 1.1)::BIGINT + 30)) AS k FROM dealt WHERE target > 0))
  WHERE r <= n GROUP BY key),
sources AS (
  SELECT t.*, coalesce(blocks, 0) AS blocks, greatest(1, least(1048576, ceil(source_size / 100000)))::BIGINT AS shards
  FROM dealt t LEFT JOIN seats USING (key)),
placed AS (
  SELECT h.*, source_size, target, block, blocks, floor(fine * shards / 1048576)::BIGINT AS shard
  FROM hashed h JOIN sources USING (key)),
shard_sizes AS (
  SELECT key, shard, any_value(block) AS block, any_value(blocks) AS blocks, sum(size) AS shard_words
  FROM placed GROUP BY key, shard),
shard_seats AS (
  SELECT key, shard, count(*) AS seats FROM (
    SELECT key, shard, blocks, row_number() OVER (PARTITION BY key ORDER BY shard_words::DOUBLE / (2 * k - 1) DESC, shard, k) AS r
    FROM (SELECT *, unnest(generate_series(1, blocks)) AS k FROM shard_sizes WHERE shard_words > 0))
  WHERE r <= blocks GROUP BY key, shard),
quotas AS (
  SELECT s.key, s.shard, ceil(shard_words / s.block)::BIGINT AS n_blocks,
         least(coalesce(seats, 0), 3 * ceil(shard_words / s.block))::BIGINT AS quota,
         ('0x' || substr(md5('mix-1:' || s.key || ':' || s.shard), 1, 8))::BIGINT AS turn
  FROM shard_sizes s LEFT JOIN shard_seats USING (key, shard)),
laid AS (
  SELECT *, coalesce(sum(size) OVER (PARTITION BY key, shard ORDER BY ord, size
                                     ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS first FROM placed)
SELECT doc_id, size, source_size, target, source,
       CASE WHEN size > 0 THEN (quota // n_blocks) * size + list_sum(list_transform(
              generate_series(first // block, (first + size - 1) // block),
              lambda j: CASE WHEN ((j % n_blocks) * 2147483647 + turn) % n_blocks < quota % n_blocks
                        THEN least(first + size, (j + 1) * block) - greatest(first, j * block) ELSE 0 END))
            ELSE 0 END::BIGINT AS taken
FROM laid JOIN quotas USING (key, shard)
"""
