"""Document fingerprints: consistent weighted sampling.

A text is a bag of terms: runs of `shingle` words (one by default), lower-cased, weighted by how often
they occur. For each of `SAMPLES` samples every term draws, from its hash alone, two gamma variables r
and c of shape two and a uniform b. A term of weight w is put at the level t = floor(ln(w) / r + b) and
gets the value ln(c) - r * (t - b + 1); the term of the least value, with its level, is the sample. Two
texts have the same sample with a probability that equals their generalised Jaccard similarity, the
sum of the smaller weights over the sum of the larger. A fingerprint holds 16 bits of each sample,
so different samples look equal once in 65,536.

The least value of a text of n words is exponential with rate n, so it lies below 32 / n but for one
sample in 10 ** 13 (which counts as zero); terms that a cheap bound puts beyond are not worked out.

Only Spark's own functions are used. Terms are counted within their row: the sorted hashes of a
text's words show where each term begins. A row for each term then goes through one
hash aggregation with a smallest number for each sample, value above and identity below. A task holds
the least numbers of its texts, and sends on one row a text; however long a text is, its
terms are never collected, and texts of one key may lie in any partition.

Null and empty texts have no terms: their samples are all zero, so they are alike and unlike any other.
Repeated rows of a key give one row; equal texts have equal fingerprints. Extra columns are
ignored; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioloom.llm.common import stored

SAMPLES = 64  # a multiple of AT_ONCE, or fewer
AT_ONCE = 32
SHINGLE = 1
#: Capitals that are lowered, and white space between words.
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
SPACES = r"[\x20\x09-\x0D]+"
DIGITS = 4  # hexadecimal, of a sample
VALUE_BITS = 23  # after the point, of a value
BEYOND = 32.0  # the least value of a text exceeds this over its words with probability exp(-32)


def let(value: Column, body) -> Column:
    """body(value), with the value computed once however often the body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def weighted_terms(text: Column, shingle: int = SHINGLE) -> Column:
    """Array of (term, weight): the hash of each different term of the text, and how often it occurs."""
    lower = F.translate(text, CAPITALS, CAPITALS.lower())
    words = F.filter(F.split(lower, SPACES), lambda w: w != "")
    if shingle == 1:
        hashes = F.transform(words, lambda w: F.xxhash64(w))
    else:
        # A text of fewer words is one term.
        hashes = let(words, lambda ws: F.transform(
            F.sequence(F.lit(1), F.greatest(F.least(F.size(ws), F.lit(1)), F.size(ws) - shingle + 1)),
            lambda i: F.xxhash64(F.array_join(F.slice(ws, i, F.lit(shingle)), " "))))
        hashes = F.when(F.trim(F.regexp_replace(text, SPACES, " ")) != "", hashes).otherwise(F.array().cast("array<bigint>"))

    def counted(sorted_hashes: Column) -> Column:
        def begins(i: Column) -> Column:
            return (i == 0) | (F.get(sorted_hashes, i) != F.get(sorted_hashes, i - 1))

        places = F.filter(F.sequence(F.lit(0), F.greatest(F.size(sorted_hashes) - 1, F.lit(0))), begins)
        return let(places, lambda starts: F.transform(starts, lambda start, i: F.struct(
            F.get(sorted_hashes, start).alias("term"),
            (F.coalesce(F.get(starts, i + 1), F.size(sorted_hashes)) - start).alias("weight"))))

    return let(F.array_sort(hashes), counted)


def sample(s: int) -> Column:
    """The sample `offset` + s of one term, given its hash `term`, its `seed` for the offset, its `weight`, the logarithm
    `log_weight` of that and `far`: a number whose upper half is the term's value and whose lower half names the term
    and its level, which is 0 for a weight of one.

    Null where even the least that the value can be is beyond `far`: no logarithm is needed to see it. With
    q = exp(-r) the value is that of c * q ** (t - b + 1), and -ln(x) is no less than 2 (1 - x) / (1 + x). The
    power is no less than q / weight, and for weight 1 no less than q / (1 - b + b * q).
    """

    def uniform(hashed: str, by: int, n: int) -> str:
        """n bits of a hash as a number between 0 and 1."""
        return f"(((shiftrightunsigned({hashed}, {by}) & {(1 << n) - 1}L) + 0.5D) * {2.0 ** -n!r}D)"

    first = f"xxhash64(seed, {s})"
    second = f"xxhash64({first})"
    q = f"({uniform(first, 0, 21)} * {uniform(first, 21, 21)})"
    b = uniform(first, 42, 22)
    x = f"({uniform(second, 0, 32)} * {uniform(second, 32, 32)})"
    level = f"if(weight = 1, 0L, floor({b} - log_weight / ln({q})))"
    value = f"(ln(-ln({x})) + ln({q}) * ({level} - {b} + 1)) * {1 << VALUE_BITS}D"
    within = f"2 * (1 - {x}) * {q} <= far * (1 + {x}) * if(weight = 1, 1 - {b} + {b} * {q}, weight)"
    return F.expr(f"CASE WHEN {within} THEN shiftleft(CAST({value} AS BIGINT), 32)"
                  f" | ((term ^ ({level} * 1000003L)) & {0xFFFFFFFF}L) END")


def fingerprints(texts: DataFrame, keys: list[str], *, text: str = "text", shingle: int = SHINGLE,
                 samples: int = SAMPLES) -> DataFrame:
    """(keys, fingerprint) for each key: four hexadecimal digits for each sample. Rows of a key have the
    same text."""
    terms = weighted_terms(F.coalesce(F.col(text).cast("string"), F.lit("")), shingle)
    rows = texts.select(*keys, terms.alias("terms"))
    total = F.aggregate("terms", F.lit(0).cast("double"), lambda sum_of, t: sum_of + t["weight"])
    # `far` comes before the terms are dealt out, or every row would carry all of them.
    rows = rows.select(*keys, (BEYOND / F.greatest(total, F.lit(1.0))).alias("far"), "terms").select(
        *keys, "far", F.explode_outer("terms").alias("t")).select(
        *keys, "far", F.col("t.term").alias("term"), F.col("t.weight").cast("double").alias("weight"),
        F.ln(F.col("t.weight").cast("double")).alias("log_weight"))
    # The samples of a term are dealt over rows: each row's code stays small enough to be compiled.
    rows = rows.withColumn("offset", F.explode(F.array(*(F.lit(at) for at in range(0, samples, AT_ONCE))))).withColumn(
        "seed", F.xxhash64("term", "offset"))
    least = rows.groupBy(*keys, "offset").agg(*(F.min(sample(s)).alias(f"s{s}") for s in range(min(samples, AT_ONCE))))
    digits = (F.lpad(F.hex(F.coalesce(F.col(f"s{s}"), F.lit(0)).bitwiseAND(F.lit((1 << 4 * DIGITS) - 1))), DIGITS, "0")
              for s in range(min(samples, AT_ONCE)))
    named = least.select(*keys, F.struct("offset", F.lower(F.concat(*digits)).alias("digits")).alias("part"))
    return named.groupBy(*keys).agg(F.array_join(F.transform(
        F.array_sort(F.collect_list("part")), lambda part: part["digits"]), "").alias("fingerprint"))


def likeness(a: Column, b: Column) -> Column:
    """The share of equal samples of two fingerprints: an estimate of the texts' generalised Jaccard similarity."""
    n = F.length(a) / DIGITS
    same = F.aggregate(F.sequence(F.lit(0), n.cast("int") - 1), F.lit(0), lambda total, i: total + F.when(
        F.substr(a, i * DIGITS + 1, F.lit(DIGITS)) == F.substr(b, i * DIGITS + 1, F.lit(DIGITS)), 1).otherwise(0))
    return same / n


def in_order(keys: DataFrame) -> DataFrame:
    """keys with `next`, `before` and `chars_before`: the following and the preceding key, in a circle.

    keys: (key, n_chars, copies), key being unique. Ranges of keys are ordered apart; two rows for each range
    come to the driver, to link the ranges.
    """
    ranged = stored(keys.repartitionByRange("key").withColumn("part", F.spark_partition_id()), "ranged")
    edges = sorted(ranged.groupBy("part").agg(
        F.min("key").alias("first"), F.max(F.struct("key", "n_chars")).alias("last")).collect(), key=lambda r: r.part)
    schema = f"part int, first {keys.schema['key'].dataType.simpleString()}, last {keys.schema['key'].dataType.simpleString()}, last_chars int"
    # Each range gets the first key of the range after it, and the last of the one before.
    around = keys.sparkSession.createDataFrame(
        [(r.part, edges[(i + 1) % len(edges)].first, edges[i - 1].last.key, edges[i - 1].last.n_chars)
         for i, r in enumerate(edges)], schema)
    order = Window.partitionBy("part").orderBy("key")
    linked = ranged.join(F.broadcast(around), "part")
    return linked.select(
        "key", "n_chars", "copies", F.coalesce(F.lead("key").over(order), "first").alias("next"),
        F.coalesce(F.lag("key").over(order), "last").alias("before"),
        F.coalesce(F.lag("n_chars").over(order), "last_chars").alias("chars_before"))


def neighbours(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE,
               samples: int = SAMPLES) -> DataFrame:
    """Per document (doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next).

    The next document is the one with the next greater doc_id, and for the last the first. In the edited
    text the last half of the code points, rounded down, makes room for the first as many of the
    next document's, or all. near_edited and near_next: the likeness of the document's fingerprint to the
    edited text's and to the next document's.

    Documents of one id come in the order of their texts' hashes; of rows that are equal in both, all
    but the last are followed by their like. Null ids come first. Texts are shuffled once, by id and hash, and
    of each no more than what the edit takes is sent on to the document before.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    # The type that written tables give back: joins then need no cast, and no other exchange.
    kind = f"struct<doc_id:{rows.schema['doc_id'].dataType.simpleString()},hash:bigint>"
    keyed = rows.select(F.struct("doc_id", F.xxhash64("text").alias("hash")).cast(kind).alias("key"), "text")
    keys = stored(keyed.groupBy("key").agg(F.max(F.length("text")).alias("n_chars"), F.count("*").alias("copies")), "keys")
    order = stored(in_order(keys), "order")
    whole = keyed.dropDuplicates(["key"]).join(order, "key")
    heads = whole.select(F.col("before").alias("key"), F.left("text", F.expr("chars_before div 2").cast("int")).alias("head"))

    def edited(head: Column) -> Column:
        half = F.expr("n_chars div 2").cast("int")
        return F.concat(F.left("text", F.col("n_chars") - half), F.left(head, half))

    # Kind 0: the text. Kind 1: edited with the next document. Kind 2: edited with its like.
    versions = F.array(
        F.struct(F.lit(0).alias("kind"), F.col("text")), F.struct(F.lit(1).alias("kind"), edited(F.col("head")).alias("text")),
        F.when(F.col("copies") > 1, F.struct(F.lit(2).alias("kind"), edited(F.col("text")).alias("text"))))
    texts = whole.join(heads, "key").select("key", F.explode(versions).alias("v")).where("v IS NOT NULL").select(
        "key", "v.kind", F.unhex(F.sha2("v.text", 256)).alias("sha256"), "v.text")
    prints = fingerprints(texts, ["key", "kind", "sha256"], shingle=shingle, samples=samples)
    own = F.max(F.when(F.col("kind") == 0, F.col("fingerprint"))).alias("fingerprint")
    others = F.filter(F.collect_list(F.struct("kind", "sha256", "fingerprint")), lambda v: v["kind"] > 0).alias("others")
    classes = stored(prints.groupBy("key").agg(own, others), "prints", "zstd")
    following = order.select("key", "n_chars", "copies", "next").join(
        classes.select(F.col("key").alias("next"), F.col("fingerprint").alias("next_fingerprint")), "next")
    each = classes.join(following, "key").select("*", F.explode("others").alias("edit"))
    near_next = F.when(F.col("edit.kind") == 1, likeness(F.col("fingerprint"), F.col("next_fingerprint"))).otherwise(1.0)
    result = each.select(
        F.col("key.doc_id").alias("doc_id"), F.col("n_chars").cast("long").alias("n_chars"),
        F.lower(F.hex("edit.sha256")).alias("edited_sha256"), "fingerprint", F.col("edit.fingerprint").alias("edited_fingerprint"),
        likeness(F.col("fingerprint"), F.col("edit.fingerprint")).alias("near_edited"), near_next.alias("near_next"),
        F.when(F.col("edit.kind") == 1, F.lit(1).cast("long")).otherwise(F.col("copies") - 1).alias("times"))
    repeated = F.explode(F.sequence(F.lit(1).cast("long"), F.col("times")))
    return result.withColumn("nth", repeated).drop("times", "nth")
