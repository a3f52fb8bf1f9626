"""Document fingerprints by consistent weighted sampling.

The terms of a text are its blank-separated words, A-Z lower-cased, words of more than ``TERM_LENGTH``
characters in pieces of that length; a term weighs as often as it occurs. For every term and sample a
hash gives r and c, both gamma distributed with shape 2, and b, uniform on [0, 1). With
t = floor(ln(weight) / r + b) the term bids ln(c) - r * (t - b + 1), and the lowest bid is the text's
sample. Two texts share a sample exactly if the same term wins with the same t, with a probability of the
generalised Jaccard similarity of their weighted terms (the sum of the smaller over that of the larger weights).
A bid depends on term and t alone, so equal bids stand for equal samples.

All is DataFrame functions. Texts are shuffled once, by a key of their own; words are counted and
sampled behind that shuffle, so neither words nor bids are moved.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aerolag.llm.tables import ranked, small_side
from aerolag.storage import stage

SAMPLES = 64
#: Samples computed side by side in one row. The JVM compiles small generated methods well and large ones not at all.
BLOCK_SAMPLES = 4
#: Hex digits of a sample: unequal samples look equal with a probability of 1 in 65,536.
DIGITS = 4
TERM_LENGTH = 16
#: A sample of which all bids were too high to be looked at has a chance of exp(-24), 4e-11.
HOPELESS = 24.0
#: Characters of text in one task, which hold the counts of some 500,000 terms.
TASK_CHARACTERS = 6_000_000


def _lowered(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text: Column) -> Column:
    """The terms of a text in order, with repeats."""
    return F.regexp_extract_all(_lowered(text), F.lit(rf"([^\x20\x09-\x0D]{{1,{TERM_LENGTH}}})"), F.lit(1))


def _product(bits: Column, shift: int) -> Column:
    """The product of two uniform numbers in (0, 1) of 16 bits each; minus its logarithm is gamma of shape 2."""
    first, second = (F.shiftright(bits, shift + k).bitwiseAND(0xFFFF) for k in (0, 16))
    return (first + 0.5) * (second + 0.5) * 2.0**-32


def _sampled(rows: DataFrame, size: int) -> DataFrame:
    """Add r, ln(c) and b of the term's samples in its block, or nulls where its bid is too high to win.

    The exponential of a bid is at least (1 - exp(-c)) * exp(-r) / weight, and the lowest of a text whose
    weights sum up to W is above ``HOPELESS`` / W with a probability of exp(-HOPELESS). So most logarithms need
    not be taken.
    """
    sample = lambda i, k: F.xxhash64("_term", F.col("_block") * size + (i + k * 65_536))
    others = [name for name in rows.columns if name not in ("_term", "_reach")]
    rows = rows.select("*", *[sample(i, 0).alias(f"_h{i}") for i in range(size)])
    products = [_product(F.col(f"_h{i}"), k).alias(f"_{name}{i}") for i in range(size) for name, k in (("u", 0), ("v", 32))]
    rows = rows.select(*others, "_term", "_reach", *products)
    drawn = []
    for i in range(size):
        u, v = F.col(f"_u{i}"), F.col(f"_v{i}")
        in_reach = (1 - v) * u <= F.col("_reach")
        drawn.append(F.when(in_reach, -F.ln(u)).alias(f"_r{i}"))
        drawn.append(F.when(in_reach, F.ln(-F.ln(v))).alias(f"_c{i}"))
        drawn.append(F.when(in_reach, F.shiftrightunsigned(sample(i, 1), 12) * 2.0**-52).alias(f"_b{i}"))
    return rows.select(*others, *drawn)


def _bid(i: int, log_weight: Column) -> Column:
    """The bid for sample ``i`` of a block; null without a weight."""
    r, b = F.col(f"_r{i}"), F.col(f"_b{i}")
    return F.col(f"_c{i}") - r * (F.floor(log_weight / r + b) - b + 1)


def fingerprints(
    words: DataFrame, keys: list[str], term: str, weights: dict[str, tuple[str, str]], samples: int = SAMPLES
) -> DataFrame:
    """One row per ``keys``: a fingerprint for each weight column of ``weights``.

    ``weights`` names, for each, the column with its sum over the key and the name of the fingerprint.
    ``words`` has one row per key and term (a 64-bit hash); a weight of 0 means that the term is not there.
    Without any term the fingerprint is empty. No shuffle where ``words`` is partitioned by one of the keys.
    """
    size = min(BLOCK_SAMPLES, samples)
    if samples % size:
        raise ValueError(f"{samples} samples do not fill blocks of {size}")
    names = list(weights)
    logs = [F.when(F.col(name) > 0, F.ln(name)).alias(f"_log_{name}") for name in names]
    block = F.explode(F.array(*[F.lit(i) for i in range(samples // size)])).alias("_block")
    shares = [F.try_divide(F.col(name) * HOPELESS, F.col(total)) for name, (total, _) in weights.items()]
    reach = F.array_max(F.array(*shares))
    rows = words.select(*keys, F.col(term).alias("_term"), reach.alias("_reach"), *logs, block)
    lowest = []
    for i in range(size):
        lowest += [F.min(_bid(i, F.col(f"_log_{name}"))).alias(f"_{name}_{i}") for name in names]
    lowest += [F.count(f"_log_{name}").alias(f"_{name}_terms") for name in names]
    rows = _sampled(rows, size)

    def digits(bid: Column) -> Column:
        # xxhash64 of a null is a value as well.
        return F.lpad(F.lower(F.hex(F.xxhash64(bid).bitwiseAND(16**DIGITS - 1))), DIGITS, "0")

    parts = []
    for name in names:
        text = F.concat(*[digits(F.col(f"_{name}_{i}")) for i in range(size)])
        parts.append(F.when(F.col(f"_{name}_terms") == 0, "").otherwise(text).alias(f"_part_{name}"))
    blocked = rows.groupBy(*keys, "_block").agg(*lowest).select(*keys, "_block", *parts)
    whole = []
    for name in names:
        ordered = F.array_sort(F.collect_list(F.struct("_block", f"_part_{name}")))
        whole.append(F.array_join(ordered[f"_part_{name}"], "").alias(weights[name][1]))
    return blocked.groupBy(*keys).agg(*whole)


def likeness(one: Column, other: Column, samples: int = SAMPLES) -> Column:
    """Share of equal samples of two fingerprints; 1 for two empty ones, 0 for an empty and another."""
    equal = F.lit(0)
    for i in range(samples):
        place = i * DIGITS + 1
        equal = equal + (F.substring(one, place, DIGITS) == F.substring(other, place, DIGITS)).cast("int")
    return F.when(one == other, 1.0).when((one == "") | (other == ""), 0.0).otherwise(equal / samples)


def _rows_by_key(keyed: DataFrame, repeated: DataFrame | None, partitions: int) -> DataFrame:
    """Each (key, text) once, partitioned by key; only the rows of ``repeated`` keys need to be made distinct."""
    rows = keyed.select("key", "text")
    if repeated is not None:
        once = rows.join(repeated, "key", "left_anti")
        rows = once.unionByName(rows.join(repeated, "key", "left_semi").dropDuplicates(["key"]))
    return rows.repartition(partitions, "key")


def document_fingerprints(
    documents: DataFrame, samples: int = SAMPLES, task_characters: int = TASK_CHARACTERS
) -> DataFrame:
    """Fingerprints of all documents (doc_id, text) and of an edited text of each.

    The edited text has the last third (rounded down) of the code points replaced by the first as many, or
    all, of the next document in descending order of doc_id; the first one follows the last. Rows of one
    doc_id are ordered by a hash of their text, so copies of a whole row follow one another; a null
    doc_id comes last. Columns: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited,
    near_next. A null text is empty; a text of white space only has no term and an empty fingerprint, which is
    like other empty ones (1) and unlike all else (0).
    """
    rows = documents.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    name = F.col("doc_id").cast("string")
    named = F.coalesce(F.concat(F.octet_length(name).cast("string"), F.lit(":"), name), F.lit("-"))
    keyed = rows.withColumn("key", F.substring(F.unhex(F.sha2(F.concat(named, F.lit(":"), "text"), 256)), 1, 16))

    counted = keyed.select("key", "doc_id", F.char_length("text").cast("long").alias("n_chars"))
    counted = counted.groupBy("key", "doc_id", "n_chars").agg(F.count("*").alias("copies"))
    order = ranked(counted, F.col("doc_id").desc_nulls_last(), F.col("key"))
    sums = [F.count("*").alias("n"), F.coalesce(F.sum("n_chars"), F.lit(0)).alias("chars"), F.max("copies").alias("most")]
    size = order.agg(*sums).first()
    place_before = F.pmod(F.col("position") - 1, F.lit(max(size["n"], 1)))
    following = order.select(place_before.alias("position"), F.col("key").alias("next_key"))
    order = stage(order.join(following, "position"), "documents-in-order")

    # Every text gives its head to the document before it; the first of two copies of a row takes its own.
    third = F.floor(F.col("n_chars") / 3).cast("int").alias("taken")
    asked = order.select(F.col("next_key").alias("key"), F.col("key").alias("taker"), third, F.lit(False).alias("own"))
    repeated = None
    if (size["most"] or 0) > 1:
        several = order.filter("copies > 1")
        asked = asked.unionByName(several.select("key", F.col("key").alias("taker"), third, F.lit(True).alias("own")))
        repeated = small_side(stage(several.select("key"), "repeated-rows"))
    cores = documents.sparkSession.sparkContext.defaultParallelism
    partitions = max(cores, -(-size["chars"] // task_characters))
    texts = _rows_by_key(keyed, repeated, partitions)
    heads = texts.join(asked.repartition(partitions, "key").hint("merge"), "key")
    head = F.substring("text", F.lit(1), F.col("taken")).alias("head")
    heads = heads.select(F.col("taker").alias("key"), "own", "taken", head).repartition(partitions, "key")
    kept = F.substring("text", F.lit(1), F.char_length("text") - F.col("taken"))
    both = texts.join(heads.hint("merge"), "key").select("key", "own", "text", F.concat(kept, "head").alias("edited"))

    # The digest goes along in the keys, so that no second pass over the texts is needed.
    keys = ["key", "own", "digest"]
    digest = F.unhex(F.sha2("edited", 256)).alias("digest")
    both = both.select("key", "own", digest, terms(F.col("text")).alias("a"), terms(F.col("edited")).alias("b"))
    # A document without terms keeps one row.
    listed = F.posexplode_outer(F.concat("a", "b")).alias("at", "word")
    words = both.select(*keys, F.size("a").alias("total"), F.size("b").alias("edited_total"), listed)
    words = words.groupBy(*keys, "total", "edited_total", F.xxhash64("word").alias("term")).agg(
        F.count(F.when(F.col("at") < F.col("total"), 1)).alias("weight"),
        F.count(F.when(F.col("at") >= F.col("total"), 1)).alias("edited_weight"),
    )
    weights = {"weight": ("total", "fingerprint"), "edited_weight": ("edited_total", "edited_fingerprint")}
    prints = stage(fingerprints(words, keys, "term", weights, samples), "fingerprints")

    own = F.col("own")
    one_each = order.withColumn("own", F.lit(False)).withColumn("times", F.lit(1).cast("long"))
    if repeated is not None:
        again = several.select("*", F.lit(True).alias("own"), (F.col("copies") - 1).alias("times"))
        one_each = one_each.unionByName(again)
    shown = one_each.join(prints, ["key", "own"])
    nexts = prints.filter(~own).select(F.col("key").alias("next_key"), F.col("fingerprint").alias("next_fingerprint"))
    shown = shown.join(nexts, "next_key")
    nearest = likeness(F.col("fingerprint"), F.col("next_fingerprint"), samples)
    found = shown.select(
        "doc_id",
        "n_chars",
        F.lower(F.hex("digest")).alias("edited_sha256"),
        "fingerprint",
        "edited_fingerprint",
        likeness(F.col("fingerprint"), F.col("edited_fingerprint"), samples).alias("near_edited"),
        F.when(own, 1.0).otherwise(nearest).alias("near_next"),
        *([F.explode(F.sequence(F.lit(1).cast("long"), "times")).alias("copy")] if repeated is not None else []),
    )
    return found.drop("copy")
