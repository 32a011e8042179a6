"""Secret scans by a battery of randomness tests, in DataFrame functions only.

Base spans: assignments to a name such as password or api_key, access keys, and runs of hex digits. Further candidates are runs
of at least TOKEN_LEAST characters of common encodings that overlap no base span. For each, the smallest alphabet that
fits is inferred, and three tests ask whether its symbols look drawn at random: chi-squared uniformity over the alphabet
(Wilson-Hilferty), runs about the middle, and lag-one serial correlation. If any rejects randomness at ALPHA (after
Bonferroni), the candidate is dropped. What is left is a discovery only if ordinary text would rarely look as uniform: the
chi-squared statistic's lower tail for text of that length (shifted by length times TEXT_EXCESS) gives a p-value, and the Benjamini-
Hochberg step-up, over all documents' candidates in each stratum of lengths, keeps the share of false
discoveries under FDR. p-values are binned by tenths of a decade for it, always rounded up.

Places are in code points, ends exclusive. Null and empty texts hold nothing. Repeated rows give repeated results.
"""
from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import id_text, stored

BASE = ("assign", "access", "hex")
WORDS = "(?i:password|passwd|secret|token|api_?key)"
ASSIGN = f"({WORDS})[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
#: A run that is long enough starts where the first of its characters may: the same matches as finding all runs and dropping short ones.
ACCESS, HEX = "AKIA[A-Z0-9]{12,}", "[0-9a-f]{32,}"
TOKEN_LEAST = 20
TOKEN = f"[A-Za-z0-9+/_-]{{{TOKEN_LEAST},}}"
UPPER, DIGITS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
LOWER = UPPER.lower()
#: Encodings from the smallest alphabet to the largest.
ALPHABETS = {"hex": DIGITS + "abcdef", "hex_upper": DIGITS + "ABCDEF", "lower": LOWER, "upper": UPPER, "base32": UPPER + "234567", "base36": DIGITS + LOWER, "letters": UPPER + LOWER, "base62": UPPER + LOWER + DIGITS, "base64": UPPER + LOWER + DIGITS + "+/", "base64url": UPPER + LOWER + DIGITS + "-_"}
#: How far text is from uniform: alphabet size times the chance that two letters of prose (or two digits of numbers) are equal, less 1.
COLLISION = {"hex": 0.1, "hex_upper": 0.1}
TEXT_COLLISION = 0.062
ALPHA, FDR = 0.001, 0.05
STRATA = (20, 32, 48, 80)


def matches(text: Column, pattern: str, kind: str, value: int, when: Column) -> Column:
    """Array of (kind, at, gap, size, value): the matches, each with the characters between it and the one before."""
    whole, given = F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.regexp_extract_all(text, F.lit(pattern), F.lit(value))
    gaps = F.split(text, pattern, -1)
    rows = F.transform(F.arrays_zip(gaps.alias("gap"), whole.alias("whole"), given.alias("value")), lambda x, i: F.struct(F.lit(kind).alias("kind"), i.alias("at"), F.length(x["gap"]).cast("long").alias("gap"), F.length(x["whole"]).cast("long").alias("size"), x["value"].alias("value")))
    return F.when(when, F.filter(rows, lambda x: x["size"].isNotNull())).otherwise(F.filter(F.array(F.struct(F.lit(kind).alias("kind"), F.lit(0).alias("at"), F.lit(0).cast("long").alias("gap"), F.lit(0).cast("long").alias("size"), F.lit("").alias("value"))), lambda x: F.lit(False)))


def scanned(docs: DataFrame) -> DataFrame:
    """row, doc_id, matches of every row in docs(doc_id, text), in one pass over the texts.

    The row ids hold for what is stored of this result only: another read of docs might deal its rows otherwise.
    """
    text = F.col("text")
    every = F.concat(
        matches(text, ASSIGN, "assign", 2, text.rlike(WORDS)), matches(text, ACCESS, "access", 0, F.contains(text, F.lit("AKIA"))),
        matches(text, HEX, "hex", 0, text.rlike(HEX)), matches(text, TOKEN, "random", 0, text.rlike(TOKEN)),
    )
    return docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", every.alias("matches"))


def found(rows: DataFrame) -> DataFrame:
    """row, base, candidates: spans in the texts that have any, by start; base as (start, rank of its kind, kind, end)."""
    each = rows.select("row", F.explode("matches").alias("m")).select("row", "m.*")
    so_far = Window.partitionBy("row", "kind").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum(F.col("gap") + F.col("size")).over(so_far)
    rank = reduce(lambda c, k: c.when(F.col("kind") == k[1], k[0]), enumerate(BASE), F).otherwise(len(BASE))
    placed = each.withColumn("end", end).where("kind <> 'assign' or length(value) >= 8")
    placed = placed.select("row", F.struct((F.col("end") - F.col("size")).alias("start"), rank.alias("rank"), "kind", "end", "value").alias("s"))
    both = placed.groupBy("row").agg(F.array_sort(F.collect_list("s")).alias("s"))
    return both.select("row", F.filter("s", lambda x: x["kind"] != "random").alias("base"), F.filter("s", lambda x: x["kind"] == "random").alias("candidates"))


def tail(z: Column) -> Column:
    """Upper tail of the normal distribution (Abramowitz and Stegun 26.2.17)."""
    t = 1 / (1 + 0.2316419 * F.abs(z))
    poly = t * (0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429))))
    upper = F.exp(-z * z / 2) * 0.3989422804014327 * poly
    return F.when(z >= 0, upper).otherwise(1 - upper)


def tested(candidates: DataFrame) -> DataFrame:
    """Adds to (row, s) the encoding, and p_random and p_text: how unusual each would be for random symbols and for text."""
    v = F.col("s.value")
    fits = [(n, v.rlike("^[" + a.replace("-", "\\-") + "]+$")) for n, a in ALPHABETS.items()]
    name = reduce(lambda c, x: c.when(x[1], F.lit(x[0])), fits, F).otherwise(F.lit("base64"))
    x = candidates.withColumn("encoding", name)
    alphabet = reduce(lambda c, a: c.when(F.col("encoding") == a[0], F.lit(a[1])), ALPHABETS.items(), F)
    equal = reduce(lambda c, a: c.when(F.col("encoding") == a[0], F.lit(a[1])), COLLISION.items(), F).otherwise(F.lit(TEXT_COLLISION))
    x = x.withColumn("alphabet", alphabet).withColumn("k", F.length("alphabet").cast("double"))
    # Characters outside the alphabet (a mix of both base-64 alphabets) count as its last symbol.
    symbols = F.transform(F.split(v, ""), lambda c: F.when(F.instr("alphabet", c) > 0, F.instr("alphabet", c).cast("double") - 1).otherwise(F.col("k") - 1))
    x = x.withColumn("x", F.filter(symbols, lambda c: c.isNotNull())).withColumn("n", F.size("x").cast("double"))
    count = F.transform(F.split("alphabet", ""), lambda c: (F.length(v) - F.length(F.replace(v, c, F.lit("")))).cast("double"))
    add = lambda array: F.aggregate(array, F.lit(0.0), lambda a, b: a + b)
    n, k = F.col("n"), F.col("k")
    x = x.withColumn("chi", add(F.transform(count, lambda c: c * c)) * k / n - n)
    df = k - 1
    z_chi = (F.pow(F.greatest(F.col("chi"), F.lit(0.0)) / df, F.lit(1 / 3)) - (1 - 2 / (9 * df))) / F.sqrt(2 / (9 * df))
    high = F.array_join(F.transform("x", lambda c: F.when(c >= k / 2, F.lit("1")).otherwise(F.lit("0"))), "")
    x = x.withColumn("high", high)
    left = lambda part: F.length("high") - F.length(F.replace(F.col("high"), F.lit(part), F.lit("")))
    ones = left("1").cast("double")
    mu = 2 * ones * (n - ones) / n + 1
    runs = 1 + (left("01") + left("10")).cast("double") / 2
    z_runs = F.when((mu > 2) & (n > 1), (runs - mu) / F.sqrt((mu - 1) * (mu - 2) / (n - 1))).otherwise(F.lit(9.0))
    mean = add(F.col("x")) / n
    x = x.withColumn("mean", mean)
    off = F.transform("x", lambda c: c - F.col("mean"))
    x = x.withColumn("off", off)
    following = F.zip_with("off", F.slice("off", F.lit(2), F.size("off")), lambda a, b: a * F.coalesce(b, F.lit(0.0)))
    spread = add(F.transform("off", lambda c: c * c))
    z_serial = F.when(spread > 0, add(following) / F.greatest(spread, F.lit(1e-9)) * F.sqrt(n)).otherwise(F.lit(9.0))
    p_random = F.least(F.lit(1.0), 3 * F.least(tail(z_chi), 2 * tail(F.abs(z_runs)), 2 * tail(F.abs(z_serial))))
    shift = n * (k * equal - 1)
    p_text = tail((df + shift - F.col("chi")) / F.sqrt(2 * df + 4 * shift))
    return x.select("row", "s", "encoding", "n", p_random.alias("p_random"), p_text.alias("p_text"))


def discoveries(scored: DataFrame) -> DataFrame:
    """The rows that pass both conditions."""
    stratum = reduce(lambda c, i: c.when(F.col("n") >= STRATA[i], i), reversed(range(1, len(STRATA))), F).otherwise(0)
    p = F.when(F.col("p_random") < ALPHA, F.lit(1.0)).otherwise(F.greatest("p_text", F.lit(1e-30)))
    scored = scored.withColumn("stratum", stratum).withColumn("bin", F.floor(-10 * F.log10(p) + F.lit(1e-9)).cast("int"))
    bins = scored.groupBy("stratum", "bin").agg(F.count(F.lit(1)).alias("m"))  # at most len(STRATA) * 301 rows
    all_of = Window.partitionBy("stratum")
    bins = bins.withColumn("total", F.sum("m").over(all_of)).withColumn("at_least", F.sum("m").over(all_of.orderBy(F.desc("bin"))))
    limits = bins.where(F.pow(F.lit(10.0), -F.col("bin") / 10) <= FDR * F.col("at_least") / F.col("total")).groupBy("stratum").agg(F.min("bin").alias("least"))
    return scored.join(F.broadcast(limits), "stratum").where("bin >= least and bin > 0")


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, base, spans of every row: arrays of structs (kind, start, end) by start, then kind as in BASE, random last."""
    rows = stored(scanned(id_text(docs, id_col, text_col)))
    some = stored(found(rows))
    overlaps = lambda c: F.exists("base", lambda b: (b["start"] < c["end"]) & (c["start"] < b["end"]))
    scored = stored(tested(some.select("row", F.explode(F.filter("candidates", lambda c: ~overlaps(c))).alias("s"))))
    new = discoveries(scored).groupBy("row").agg(F.collect_list("s").alias("new"))
    both = some.select("row", "base").join(new, "row", "left")
    none = F.filter("base", lambda x: F.lit(False))
    plain = lambda a: F.transform(a, lambda x: F.struct(x["kind"].alias("kind"), x["start"].alias("start"), x["end"].alias("end")))
    both = both.select("row", plain("base").alias("base"), plain(F.array_sort(F.concat("base", F.coalesce("new", none)))).alias("spans"))
    empty = F.from_json(F.lit("[]"), "array<struct<kind: string, start: long, end: long>>")
    return rows.select("row", "doc_id").join(both, "row", "left").select("doc_id", F.coalesce("base", empty).alias("base"), F.coalesce("spans", empty).alias("spans"))
