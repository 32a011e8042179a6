"""Translation efficiency, differential results, and sample-level quality control."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import ranking


def efficiency(ribo: Column, rna: Column) -> Column:
    """ribo / rna; null where rna is 0."""
    return F.try_divide(ribo, rna)


def te_pairs(rpkm: DataFrame, pairs: dict[str, str]) -> DataFrame:
    """id, method, cond, rep, te from rpkm(id, method, cond, rep, rpkm), a row each: each method by its partner of the same condition and replicate.

    Both are found by one grouping of the table, which is read once. No method is in two pairs.
    """
    pair_of = F.create_map(*[F.lit(x) for top, low in pairs.items() for x in (top, top, low, top)])
    x = rpkm.withColumn("pair", F.try_element_at(pair_of, F.col("method"))).where("pair is not null")
    of = lambda top: F.max(F.when((F.col("method") == F.col("pair")) == top, F.struct("rpkm")))
    both = x.groupBy("id", F.col("pair").alias("method"), "cond", "rep").agg(of(True).alias("top"), of(False).alias("low")).where("top is not null and low is not null")
    return both.select("id", "method", "cond", "rep", efficiency(F.col("top.rpkm"), F.col("low.rpkm")).alias("te"))


def te_means(te: DataFrame) -> DataFrame:
    """id, method, cond, te_avg: mean over replicates that have a ratio; only for conditions with more than one replicate."""
    out = te.groupBy("id", "method", "cond").agg(F.avg("te").alias("te_avg"), F.count(F.lit(1)).alias("reps"))
    return out.where("reps > 1").drop("reps")


def direction(fold: str, p: str, least_fold: float, most_p: float) -> Column:
    """up, down or none, limits included; a missing or NaN value is none."""
    good = ~F.isnan(F.coalesce(F.col(p), F.lit(float("nan")))) & ~F.isnan(F.coalesce(F.col(fold), F.lit(float("nan")))) & (F.col(p) <= most_p)
    return F.when(good & (F.col(fold) >= least_fold), "up").when(good & (F.col(fold) <= -least_fold), "down").otherwise("none")


def pooled(tables: dict[str, DataFrame]) -> DataFrame:
    """All contrasts' rows, each with its tool."""
    from .predictions import united

    return united([df.withColumn("tool", F.lit(tool)) for tool, df in tables.items()])


def all_three(ribo: DataFrame, rna: DataFrame, te: DataFrame, key: str = "id") -> DataFrame:
    """Rows that have all three results, their columns prefixed."""
    named = lambda df, p: df.select(key, *[F.col(c).alias(f"{p}_{c}") for c in df.columns if c != key])
    return named(ribo, "ribo").join(named(rna, "rna"), key).join(named(te, "te"), key)


def placed(results: DataFrame, annotation: DataFrame) -> DataFrame:
    """results(id) with the annotation's place, else the one that the id itself spells; an id without either raises."""
    from ..functions.coords import parsed
    from .predictions import LOCUS

    a = annotation.groupBy("id").agg(F.min(F.struct(*LOCUS)).alias("a"))  # one place an id
    place = F.coalesce("a", parsed("id"), F.raise_error(F.concat(F.lit("neither annotated nor a locus: "), "id")).cast("struct<chrom: string, start1: bigint, stop1: bigint, strand: string>"))
    return results.join(a, "id", "left").withColumn("place", place).drop("a").select(*results.columns, "place.*")


def sorted_results(results: DataFrame, group: str, order: str) -> DataFrame:
    """results with place: their number within the group by the adjusted p-value padj, missing ones last, then locus, then order. Tied p-values are spread over tasks too."""
    from .predictions import LOCUS

    return ranking.ranked(results, [group], [F.asc_nulls_last("padj"), *map(F.col, LOCUS), F.col(order)], "place")


def ratio_columns(samples: list[tuple[str, str, str]]) -> list[str]:
    """Column names of a table of ratios: method-condition-replicate of each sample(method, condition, replicate), and -avg after those with several replicates."""
    out: list[str] = []
    for method, condition in dict.fromkeys((m, c) for m, c, _ in samples):
        own = [f"{method}-{condition}-{r}" for m, c, r in samples if (m, c) == (method, condition)]
        out += [*own, *([f"{method}-{condition}-avg"] if len(own) > 1 else [])]
    return out


def contrast_pairs(conditions: DataFrame) -> DataFrame:
    """Every pair of conditions once, in case-insensitive order."""
    a = conditions.select(F.col("cond").alias("a"))
    b = conditions.select(F.col("cond").alias("b"))
    less = (F.lower("a") < F.lower("b")) | ((F.lower("a") == F.lower("b")) & (F.col("a") < F.col("b")))
    return a.join(b, less).select(F.concat_ws("-", "a", "b").alias("contrast"), "a", "b")


def has_replicates(samples: DataFrame) -> DataFrame:
    """One row: whether each method and condition has two replicates or more."""
    n = samples.groupBy("method", "cond").agg(F.countDistinct("rep").alias("n"))
    return n.agg(F.bool_and(F.col("n") >= 2).alias("has_replicates"), F.count(F.lit(1)).alias("groups"))


def mean_variance(counts: DataFrame) -> DataFrame:
    """id, method, cond, mean, variance over replicates of counts(id, method, cond, rep, cnt)."""
    return counts.groupBy("id", "method", "cond").agg(F.avg("cnt").alias("mean"), F.var_samp("cnt").alias("variance"))


def size_factors(counts: DataFrame, libraries: int) -> DataFrame:
    """library, size_factor: the median ratio to the genes' geometric means, over the genes that every library counts."""
    logs = counts.where("cnt > 0").withColumn("l", F.ln("cnt"))
    means = logs.groupBy("id").agg(F.avg("l").alias("m"), F.count(F.lit(1)).alias("k")).where(F.col("k") == libraries).drop("k")
    return logs.join(means, "id").groupBy("library").agg(F.exp(F.percentile(F.col("l") - F.col("m"), 0.5)).alias("size_factor"))


def normalised(counts: DataFrame, factors: DataFrame) -> DataFrame:
    """counts with norm = cnt / size factor; the factors are a row a library."""
    return counts.join(factors, "library").withColumn("norm", F.col("cnt") / F.col("size_factor"))


def correlations(values: DataFrame, key: str, value: str) -> DataFrame:
    """lib_a, lib_b, r: Pearson correlation of each pair of libraries over their common keys."""
    a = values.select(key, F.col("library").alias("lib_a"), F.col(value).alias("va"))
    b = values.select(key, F.col("library").alias("lib_b"), F.col(value).alias("vb"))
    return a.join(b, key).groupBy("lib_a", "lib_b").agg(F.corr("va", "vb").alias("r"))


def bin_ranks(values: DataFrame, key: str, value: str) -> DataFrame:
    """Adds rank: the mean rank among the library's keys, ties shared."""
    return ranking.mean_ranked(values, ["library"], value)


def most_variable(values: DataFrame, key: str, value: str, k: int) -> DataFrame:
    """The k keys whose values vary most over libraries, ties by key.

    A key's values (one a library) are added up in their order, from the least on, so equal sets of values have equal variances, and whole numbers exact sums.
    """
    held = F.array_sort(F.collect_list(F.col(value).cast("double")))
    x = values.groupBy(key).agg(held.alias("held")).withColumn("held", F.transform("held", lambda v: v - F.col("held")[0]))
    added = lambda of: F.aggregate("held", F.lit(0.0), lambda s, v: s + of(v))
    n = F.size("held").cast("double")
    variance = F.greatest(n * added(lambda v: v * v) - added(lambda v: v) * added(lambda v: v), F.lit(0.0)) / (n * (n - 1))
    return x.select(key, F.when(n > 1, variance).alias("variance")).orderBy(F.desc_nulls_last("variance"), key).limit(k)


def principal_components(values: DataFrame, key: str, value: str, keys: list[str], k: int = 3) -> DataFrame:
    """library, pc1.., share1..: scores of the libraries on the first components over the listed keys, centred. Signs are arbitrary.

    The libraries' scalar products are summed in Spark; only this small square (a row and column a library) is decomposed.
    """
    import numpy as np

    some = values.where(F.col(key).isin(keys)) if keys else values
    centred = some.withColumn("c", F.col(value) - F.avg(value).over(Window.partitionBy(key)))
    a = centred.select(key, F.col("library").alias("a"), F.col("c").alias("ca"))
    b = centred.select(key, F.col("library").alias("b"), F.col("c").alias("cb"))
    rows = a.join(b, key).groupBy("a", "b").agg(F.sum(F.col("ca") * F.col("cb")).alias("g")).collect()
    names = sorted({r[0] for r in rows})
    gram = np.zeros((len(names), len(names)))
    for r in rows:
        gram[names.index(r[0]), names.index(r[1])] = r[2]
    w, v = np.linalg.eigh(gram)
    order = np.argsort(-w)[:k]
    scores, share = v[:, order] * np.sqrt(np.maximum(w[order], 0)), np.maximum(w[order], 0) / max(np.maximum(w, 0).sum(), 1e-300)
    schema = "library string, " + ", ".join([f"pc{i + 1} double" for i in range(len(order))] + [f"share{i + 1} double" for i in range(len(order))])
    return values.sparkSession.createDataFrame([(n, *map(float, scores[i]), *map(float, share)) for i, n in enumerate(names)], schema)


def histogram(counts: DataFrame, bins: int) -> DataFrame:
    """library, bin, n: counts in equal bins from 0 to the largest count of all."""
    top = counts.agg(F.max("cnt").alias("top"))
    x = counts.join(F.broadcast(top))
    b = F.least(F.floor(F.col("cnt") * bins / F.greatest("top", F.lit(1e-9))), F.lit(bins - 1)).cast("long")
    return x.groupBy("library", b.alias("bin")).agg(F.count(F.lit(1)).alias("n"))


def sample_meta(samples: DataFrame) -> DataFrame:
    """name (method_condition_replicate), sampletype (method_condition), expr (condition) of each sample."""
    return samples.select(F.concat_ws("_", "method", "cond", "rep").alias("name"), F.concat_ws("_", "method", "cond").alias("sampletype"), F.col("cond").alias("expr"))


#: What tracks are made of, and methods whose reads are footprints of ribosomes.
TRACK_STYLES, TRACK_NORMS, TRACK_STRANDS, FOOTPRINTS = ("global", "centered", "fiveprime", "threeprime"), ("raw", "mil", "min"), ("fwd", "rev"), ("RIBO", "TIS", "TTS")


def track_list(samples: DataFrame) -> DataFrame:
    """track, style, norm, library, strand: every track of every sample(library)."""
    every = lambda values: F.explode(F.array(*map(F.lit, values)))
    x = samples.select("library").distinct().withColumn("style", every(TRACK_STYLES)).withColumn("norm", every(TRACK_NORMS)).withColumn("strand", every(TRACK_STRANDS))
    return x.select(F.concat_ws(".", "library", "norm", "strand", "style").alias("track"), "style", "norm", "library", "strand")


def footprints(samples: DataFrame) -> DataFrame:
    """Samples that profiles are made of."""
    return samples.where(F.col("method").isin(*FOOTPRINTS))


def of_result_file(path: Column) -> Column:
    """(contrast, tool) of a result file named contrast_tool... or contrast alone (tool null)."""
    parts = F.split(F.regexp_replace(F.element_at(F.split(path, "/"), -1), r"\.[^.]*$", ""), "_")
    return F.struct(F.nullif(parts[0], F.lit("")).alias("contrast"), F.get(parts, F.lit(1)).alias("tool"))


def file_name(path: Column) -> Column:
    """What follows the last / of a path; null for null and empty ones."""
    return F.nullif(F.element_at(F.split(path, "/"), -1), F.lit(""))


def by_score(calls: DataFrame, score: str, ties: list[str]) -> DataFrame:
    """calls with place: their number by rising score, missing ones first, then by ties, a total order."""
    return ranking.ranked(calls, [], [F.asc_nulls_first(score), *map(F.col, ties)], "place")
