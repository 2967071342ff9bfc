"""Mixing sources to target weights by Pareto order sampling (DataFrame functions only).

Sizes are numbers of words.  Sources in code point order (NULL last) take the
weights in turn and share the whole size of the corpus; a target stops at
``max_copies`` times its source's size, and the excess is shared again by
weight among the others until none is above.  In closed form: with the sources
ordered by cap over weight, the capped ones are a prefix.

A source's ratio of target to size gives every document its certain whole
copies (the integer part).  The rest of the target is a fixed-size sample in
words: each document draws u from a hash of its id, and documents are ranked by
the random odds u/(1-u) divided by their inclusion odds, which are f/(1-f) for
the fraction f the source still needs, times the document's ``preference``
(a document longer than what is still needed has no chance).  The sample is the
longest run of lowest ranks that fits; the gap it leaves is sampled once more
from the documents that fit into it; at last the one document left out that
brings the source nearest to its target joins, if any does.

The run is found without sorting a source in one task: sums over coarse rank
buckets, then over fine ones inside the crossing bucket, then a window over
the rows of one fine bucket.

Edge cases: NULL text has size 0 and takes 0; NULL source is a source; NULL ids
draw like an id of their own; rows that repeat an id are separate rows whose
ties go by an internal row number; an empty corpus gives no rows.  Reruns give the same
rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.common import staged

WEIGHTS = (5, 2, 1)
MAX_COPIES = 3
ROUNDS = 2
SEED = "mix"
_COARSE, _FINE = 64, 65536  # buckets in a unit of log odds
_DRAWS = float(1 << 52)


def word_count(text: Column | str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text) if isinstance(text, str) else text, F.lit(r"[^\x20\x09-\x0D]+"))
                      .cast("long"), F.lit(0).cast("long"))


def draw(doc_id: Column, seed: str = SEED) -> Column:
    """Uniform in (0, 1) from 52 bits of a digest of the id."""
    digest = F.md5(F.concat(F.lit(seed + ":"), F.coalesce(doc_id.cast("string"), F.lit(""))))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + F.lit(0.5)) / F.lit(_DRAWS)


def source_targets(sizes: DataFrame, weights=WEIGHTS, max_copies: int = MAX_COPIES) -> DataFrame:
    """(source, source_size, target) from (source, size); one row per source."""
    one = Window.orderBy(F.col("source").asc_nulls_last())  # over the sources, one row each
    every = Window.partitionBy()
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    turn = (F.row_number().over(one) - 1) % len(weights)
    per = per.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (turn + 1).cast("int"))) \
        .withColumn("cap", F.col("source_size").cast("double") * max_copies)
    before = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last()) \
        .rowsBetween(Window.unboundedPreceding, -1)
    per = per.withColumn("total", F.sum("source_size").over(every).cast("double")) \
        .withColumn("all_weight", F.sum("weight").over(every)) \
        .withColumn("left_words", F.col("total") - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) \
        .withColumn("left_weight", F.col("all_weight") - F.coalesce(F.sum("weight").over(before), F.lit(0.0))) \
        .withColumn("capped", F.col("cap") * F.col("left_weight") <= F.col("left_words") * F.col("weight"))
    free_words = F.col("total") - F.coalesce(F.sum(F.when(F.col("capped"), F.col("cap"))).over(every), F.lit(0.0))
    free_weight = F.sum(F.when(~F.col("capped"), F.col("weight"))).over(every)
    return per.withColumn("target", F.when(F.col("capped"), F.col("cap"))
                          .otherwise(free_words * F.col("weight") / free_weight)) \
        .select("source", "source_size", "target")


def _crossing(sums: DataFrame, bucket: str, start: Column) -> DataFrame:
    """Per source: the bucket in which the running size passes the wanted
    words, and the size before it. ``sums``: (key, wanted, bucket, words)."""
    before = Window.partitionBy("key").orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    run = sums.withColumn("before", start + F.coalesce(F.sum("words").over(before), F.lit(0).cast("long")))
    return run.where((F.col("before") <= F.col("wanted")) & (F.col("before") + F.col("words") > F.col("wanted"))) \
        .select("key", bucket, "before")


def _sums(part: DataFrame, *cols: str) -> DataFrame:
    return part.groupBy("key", "wanted", *cols).agg(F.sum("size").alias("words"))


def _cut(fits: DataFrame) -> DataFrame:
    """Per source: where the longest run of lowest ranks within ``wanted`` words
    ends (fine bucket; last rank, id and row inside it) and its words."""
    coarse = staged(_sums(fits, "coarse"), "mix-coarse-sums")
    at_coarse = staged(_crossing(coarse, "coarse", F.lit(0)), "mix-coarse")
    inside = fits.join(at_coarse, ["key", "coarse"]).withColumnRenamed("before", "base")
    at_fine = staged(_crossing(_sums(inside, "base", "fine"), "fine", F.col("base")), "mix-fine")
    upto = Window.partitionBy("key").orderBy("rank", "doc_id", "row").rowsBetween(Window.unboundedPreceding, 0)
    last = fits.join(at_fine, ["key", "fine"]).withColumn("upto", F.col("before") + F.sum("size").over(upto)) \
        .where(F.col("upto") <= F.col("wanted")) \
        .groupBy("key").agg(F.max(F.struct("rank", F.col("doc_id").alias("id"), "row", "upto")).alias("last"))
    return coarse.groupBy("key").agg(F.sum("words").alias("all_words")) \
        .join(at_fine, "key", "left").join(last, "key", "left") \
        .select("key", F.coalesce("fine", F.lit((1 << 63) - 1)).alias("cut_fine"), "last",
                F.coalesce("last.upto", "before", "all_words").alias("sampled"))


def mix(docs: DataFrame, weights=WEIGHTS, max_copies: int = MAX_COPIES, preference: Column | None = None,
        seed: str = SEED, carry: bool = False) -> DataFrame:
    """One row per input row: doc_id, size, source_size, target, copies, taken
    (= copies * size).  ``preference`` (positive, over the columns doc_id,
    source, size) scales a document's inclusion odds.  ``carry`` keeps the
    input row as the struct ``doc``."""
    own = [F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc")] if carry else []
    rows = staged(docs.select(
        F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"),
        F.col("source").cast("string").alias("source"), word_count().alias("size"), *own), "mix-rows")
    rows = rows.withColumn("key", F.when(F.col("source").isNull(), "-").otherwise(F.concat(F.lit("+"), "source"))) \
        .withColumn("u", draw(F.col("doc_id"), seed)) \
        .withColumn("liking", (preference if preference is not None else F.lit(1.0)).cast("double"))
    light = rows.drop("doc")
    targets = staged(
        source_targets(light, weights, max_copies)
        .withColumn("ratio", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0))
        .withColumn("whole", F.floor("ratio"))
        .withColumn("f", F.col("ratio") - F.col("whole"))
        .withColumn("wanted", F.col("target") - F.col("whole") * F.col("source_size"))
        .withColumn("key", F.when(F.col("source").isNull(), "-").otherwise(F.concat(F.lit("+"), "source")))
        .drop("source"), "mix-targets")
    odds = F.when((F.col("f") > 0) & (F.col("f") < 1), F.col("f") / (1 - F.col("f"))).otherwise(1.0)
    ranked = light.join(targets.select("key", "f", "wanted"), "key") \
        .withColumn("rank", F.log(F.col("u") / (1 - F.col("u")) / (odds * F.col("liking")))) \
        .withColumn("coarse", F.floor(F.col("rank") * _COARSE)).withColumn("fine", F.floor(F.col("rank") * _FINE))

    marked = ranked.withColumn("chosen", F.lit(False)).withColumnRenamed("wanted", "gap")
    for _ in range(ROUNDS):
        fits = ~F.col("chosen") & (F.col("size") > 0) & (F.col("size") <= F.col("gap"))
        cut = staged(_cut(marked.where(fits).drop("chosen").withColumnRenamed("gap", "wanted")), "mix-cut")
        below = (F.col("fine") < F.col("cut_fine")) | (
            (F.col("fine") == F.col("cut_fine")) & F.col("last").isNotNull()
            & (F.struct("rank", F.col("doc_id").alias("id"), "row") <= F.struct("last.rank", "last.id", "last.row")))
        marked = marked.join(cut, "key", "left") \
            .withColumn("chosen", F.col("chosen") | F.coalesce(fits & below, F.lit(False))) \
            .withColumn("gap", F.col("gap") - F.coalesce("sampled", F.lit(0))).drop("cut_fine", "last", "sampled")
    gap = F.col("gap")
    closing = staged(
        marked.where(~F.col("chosen") & (F.col("size") > 0) & (F.abs(F.col("size") - gap) < gap))
        .groupBy("key").agg(F.min(F.struct(F.abs(F.col("size") - gap).alias("miss"), "rank", F.col("doc_id").alias("id"),
                                           F.col("row").alias("row"))).alias("best"))
        .select("key", F.col("best.row").alias("closing")), "mix-closing")
    copies = marked.join(closing, "key", "left") \
        .select("row", F.col("chosen").cast("int").alias("chosen"),
                F.coalesce(F.col("row") == F.col("closing"), F.lit(False)).cast("int").alias("closes"), "key")
    out = copies.join(targets.select("key", "source_size", "target", "whole"), "key") \
        .select("row", "source_size", "target", (F.col("whole") + F.col("chosen") + F.col("closes")).alias("copies"))
    if not carry:
        light_out = light.select("row", "doc_id", "size")
        return light_out.join(out, "row").select("doc_id", "size", "source_size", "target", "copies",
                                                 (F.col("copies") * F.col("size")).alias("taken"))
    return rows.select("row", "doc", "size").join(out, "row").select(
        "doc.doc_id", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"), "doc")


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The columns of ``docs``, each row as often as the mix takes it."""
    taken = mix(docs, carry=True, **options)
    return taken.where("copies > 0").select("doc", F.explode(F.sequence(F.lit(1).cast("long"), "copies")).alias("copy")) \
        .select("doc.*")


#: DuckDB SQL for op6 (the ranks in one window, no buckets)
ORACLE = r"""
WITH rows AS (
  SELECT row_number() OVER () AS rn, doc_id, source,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         (('0x' || substr(md5('mix:' || coalesce(doc_id::VARCHAR, '')), 1, 13))::BIGINT::DOUBLE + 0.5)
           / 4503599627370496.0 AS u
  FROM documents),
per AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         list_extract([5.0, 2.0, 1.0]::DOUBLE[], ((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT) AS weight
  FROM rows GROUP BY source),
caps AS (SELECT *, source_size::DOUBLE * 3 AS cap, sum(source_size) OVER ()::DOUBLE AS total,
                sum(weight) OVER () AS all_weight FROM per),
fill AS (
  SELECT *, cap * (all_weight - coalesce(sum(weight) OVER w, 0.0))
              <= (total - coalesce(sum(cap) OVER w, 0.0)) * weight AS capped
  FROM caps WINDOW w AS (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
targets AS (
  SELECT source, source_size,
         CASE WHEN capped THEN cap
              ELSE (total - coalesce(sum(CASE WHEN capped THEN cap END) OVER (), 0.0)) * weight
                   / sum(CASE WHEN NOT capped THEN weight END) OVER () END AS target
  FROM fill),
shares AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END::BIGINT AS whole,
         CASE WHEN source_size > 0 THEN target / source_size - floor(target / source_size) ELSE 0.0 END AS f
  FROM targets),
ranked AS (
  SELECT r.rn, r.doc_id, r.size, s.*, s.target - s.whole * s.source_size AS wanted,
         ln(r.u / (1 - r.u) / (CASE WHEN f > 0 AND f < 1 THEN f / (1 - f) ELSE 1.0 END
                               * (1.0 / sqrt(greatest(r.size, 1)::DOUBLE)))) AS rank
  FROM rows r JOIN shares s ON r.source IS NOT DISTINCT FROM s.source),
run1 AS (
  SELECT *, sum(CASE WHEN size <= wanted THEN size ELSE 0 END) OVER (
              PARTITION BY source ORDER BY rank, doc_id, rn ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto
  FROM ranked),
pick1 AS (SELECT *, size > 0 AND size <= wanted AND upto <= wanted AS first_pick FROM run1),
gap1 AS (SELECT *, wanted - sum(CASE WHEN first_pick THEN size ELSE 0 END) OVER (PARTITION BY source) AS gap_one FROM pick1),
run2 AS (
  SELECT *, sum(CASE WHEN NOT first_pick AND size <= gap_one THEN size ELSE 0 END) OVER (
              PARTITION BY source ORDER BY rank, doc_id, rn ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto2
  FROM gap1),
pick2 AS (SELECT *, first_pick OR (size > 0 AND size <= gap_one AND upto2 <= gap_one) AS chosen FROM run2),
marked AS (SELECT *, wanted - sum(CASE WHEN chosen THEN size ELSE 0 END) OVER (PARTITION BY source) AS gap FROM pick2),
best AS (
  SELECT *, CASE WHEN NOT chosen AND size > 0 AND abs(size - gap) < gap
                 THEN row_number() OVER (PARTITION BY source, (NOT chosen AND size > 0 AND abs(size - gap) < gap)
                                         ORDER BY abs(size - gap), rank, doc_id, rn) END AS place
  FROM marked)
SELECT doc_id, size, source_size, target,
       (whole + chosen::BIGINT + (coalesce(place, 0) = 1)::BIGINT) * size AS taken
FROM best
"""
