"""Document fingerprints by consistent weighted sampling; DataFrame functions only.

Each of K samples draws, for a term of weight w, r and c from Gamma(2, 1) and b from [0, 1). With
t = floor(ln w / r + b) the term's rank is c exp(-r (t - b + 1)); the term of lowest rank and its t are the
sample. Two documents draw the same one with the probability of their generalised Jaccard similarity, the
sum of the smaller weights over the sum of the larger ones.

The draws are made of three independent ones, so that the usual weight of one costs a hash and no more:
x and y from an exponential distribution and u from [0, 1). c = x + y and v = x / (x + y) are independent,
c from Gamma(2, 1) and v uniform; so are r = -ln u - ln v and b = -ln u / r. Then r (1 - b) = -ln v, and
the rank is c v exp(-r t) = x exp(-r t). As t = 0 for a weight of one (and wherever w v < 1), the rank is x
itself, whose order is that of the uniform number x is made from: the hash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ctxloom.llm.common import stored, wide_hash
from ctxloom.runtime import parallelism

SAMPLES = 128
FREQUENT = 1 << 15  # terms with a weight whose samples go to every task: 1 KB each
_LOOKED_AT = 16
_PART = 8
_HALF = 1 << 31
_TOP = "9223372036854775807"


def _sample(k: int, known: str = "") -> str:
    """Sample ``part * _PART + k`` of a term with hash ``h`` and weight ``w``: 1 - exp(-rank) in steps of 2^-63.

    The least of a text's names the sampled term and its t. ``known`` is a further case, for a weight above one.
    """
    hashed = f"xxhash64(h, part * {_PART} + {k})"
    plain = f"({hashed} & {_TOP})"
    more = f"xxhash64({hashed}, 1)"
    x = f"(-log1p(-(shiftrightunsigned({plain}, 11) + 0.5D) / 4503599627370496D))"
    y = f"(-ln((({more} & 4294967295) + 0.5D) / 4294967296D))"
    ln_u = f"ln((shiftrightunsigned({more}, 32) + 0.5D) / 4294967296D)"
    r = f"(-{ln_u} - ln({x} / ({x} + {y})))"
    t = f"floor((ln(w) - {ln_u}) / {r})"
    far = f"cast(-expm1(-{x} * exp(-{r} * {t})) * {_TOP}D as bigint)"
    return f"case when w = 1 then {plain} {known} when w * {x} < {x} + {y} then {plain} else {far} end"


def _in_parts(rows: DataFrame, samples: int) -> DataFrame:
    """The rows once for every part of the samples: code for many samples at once is not compiled."""
    return rows.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(-(-samples // _PART) - 1))))


def _least(terms: DataFrame, keys: list[str], samples: int, known: str = "") -> DataFrame:
    """(keys, part, x0, x1, ...): the least samples over the rows of each key. Aggregates are compiled, arrays of samples are not."""
    least = [F.expr(f"min({_sample(k, known.format(k=f'part * {_PART} + {k}'))})").alias(f"x{k}") for k in range(_PART)]
    return _in_parts(terms, samples).groupBy(*keys, "part").agg(*least)


def _joined(parts: DataFrame, keys: list[str], own: Column, samples: int) -> DataFrame:
    """(keys, own): the parts' arrays as one."""
    whole = parts.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("part", own.alias("own")))).alias("parts"))
    return whole.select(*keys, F.slice(F.flatten(F.transform("parts", lambda p: p["own"])), 1, samples).alias("own"))


def _weights(rows: DataFrame, keys: list[str], text: str) -> DataFrame:
    """(keys, h, w): the hash of each word in a text, in lower case, and how often it occurs."""
    # A column of its own: within explode, a text would be split for its size and again for its words.
    split = rows.select(*keys, F.array_remove(F.split(F.lower(text), r"\s+"), "").alias("words"))
    words = F.when(F.size("words") > 0, F.col("words")).otherwise(F.array(F.lit("")))
    terms = split.select(*keys, F.explode(words).alias("term"))
    weights = terms.groupBy(*keys, "term").agg(F.count(F.lit(1)).alias("w"))
    return weights.select(*keys, F.xxhash64("term").alias("h"), "w")


def _frequent(keyed: DataFrame, samples: int) -> DataFrame:
    """(h, w, drawn): all samples of the terms and weights above one most often met, FREQUENT rows at most.

    They are looked for among one text in _LOOKED_AT, chosen by hash. What is found saves time and changes
    no result: a sample is the same wherever it is drawn. For a weight of one drawing is as quick.
    """
    some = keyed.filter(F.pmod("d1", F.lit(_LOOKED_AT)) == 0)
    often = _weights(_texts(some), ["d1", "d2"], "text").filter("w > 1").groupBy("h", "w").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    often = often.orderBy(F.desc("n"), "h", "w").limit(FREQUENT)
    often = often.select("h", "w").repartition(parallelism(keyed.sparkSession), "h", "w")
    drawn = F.array(*[f"x{k}" for k in range(_PART)])
    return _joined(_least(often, ["h", "w"], samples), ["h", "w"], drawn, samples).withColumnRenamed("own", "drawn")


def _sketches(rows: DataFrame, keys: list[str], text: str, samples: int, frequent: DataFrame) -> DataFrame:
    """(keys, signature array<int>) of each row's text; ``rows`` must be partitioned by (a part of) the keys.

    A term's samples are taken from ``frequent``, whose size is bounded, or drawn in place.
    """
    terms = _weights(rows, keys, text).join(F.broadcast(frequent), ["h", "w"], "left")
    least = _least(terms, keys, samples, "when drawn is not null then get(drawn, {k})")
    # The middle bits differ between terms; the last ones of a far rank are rounded.
    own = F.array(*[(F.shiftright(f"x{k}", 12).bitwiseAND(F.lit(0xFFFFFFFF)) - _HALF).cast("int") for k in range(_PART)])
    return _joined(least, keys, own, samples).withColumnRenamed("own", "signature")


def likeness(one: str, other: str, samples: int = SAMPLES) -> Column:
    """Share of equal samples: an estimate of the generalised Jaccard similarity."""
    same = F.zip_with(one, other, lambda x, y: (x == y).cast("int"))
    return F.aggregate(same, F.lit(0), lambda n, x: n + x) / F.lit(float(samples))


def signature_text(signature: str) -> Column:
    return F.array_join(F.transform(signature, lambda x: F.lower(F.lpad(F.hex(x.cast("bigint") + _HALF), 8, "0"))), "")


def fingerprint_texts(docs: DataFrame, samples: int = SAMPLES) -> DataFrame:
    """(doc_id, signature) of each text's words in lower case, weighted by how often they occur.

    One row per different (doc_id, text) of ``docs``; null texts count as empty, and all texts without words
    have the same signature. Other columns are not looked at.
    """
    keyed = _keyed(docs)
    ids = keyed.select("d1", "d2", "doc_id").distinct()
    texts = _texts(keyed)
    sketches = _sketches(texts, ["d1", "d2"], "text", samples, _frequent(keyed, samples))
    return ids.join(sketches, ["d1", "d2"]).drop("d1", "d2")


def _keyed(docs: DataFrame) -> DataFrame:
    filled = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    d1, d2 = wide_hash("doc_id", "text")
    return filled.select(d1.alias("d1"), d2.alias("d2"), "doc_id", "text")


def _texts(keyed: DataFrame) -> DataFrame:
    """(d1, d2, text): repeated rows once, partitioned by the key. The plan's one shuffle of whole texts, used again wherever this stands."""
    return _by_key(keyed.select("d1", "d2", "text")).dropDuplicates(["d1", "d2"])


def _by_key(rows: DataFrame) -> DataFrame:
    # Four times the usual partitions: a task counts all words of its documents in memory.
    n = 4 * int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(n, "d1", "d2")


def _next_keys(ids: DataFrame) -> DataFrame:
    """``ids`` (d1, d2, doc_id, n_chars) with n1, n2: the document after each, by falling doc_id and then key; the first follows the last.

    Ids are dealt out by range, numbered in their range, and ranges are joined end to head. No task sees
    more than its range; one row per range says where the next begins.
    """
    n = int(ids.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col("doc_id").desc_nulls_last(), F.col("d1").desc(), F.col("d2").desc()]
    dealt = ids.repartitionByRange(n, *order).withColumn("part", F.spark_partition_id())
    dealt = stored(dealt.select("doc_id", "d1", "d2", "n_chars", "part", F.struct(F.col("doc_id").isNotNull(), "doc_id", "d1", "d2").alias("o")), "order")
    heads = dealt.groupBy("part").agg(F.max("o").alias("head"))
    follow = heads.select("part", F.expr("lead(head) over (order by part)").alias("head"))
    first = heads.agg(F.max("head").alias("top"))
    follow = follow.crossJoin(F.broadcast(first)).select("part", F.coalesce("head", "top").alias("head"))
    within = dealt.withColumn("ahead", F.expr("lead(o) over (partition by part order by o desc)"))
    joined = within.join(F.broadcast(follow), "part").withColumn("next", F.coalesce("ahead", "head"))
    return joined.select("d1", "d2", "doc_id", "n_chars", F.col("next.d1").alias("n1"), F.col("next.d2").alias("n2"))


def compare_with_edits(docs: DataFrame, samples: int = SAMPLES) -> DataFrame:
    """(doc_id, n_chars, edited_sha256, signature, edited_signature, next_signature): each text, its edit and the text that follows.

    The edit puts the first characters of the next document (by falling doc_id, those without doc_id last;
    the first follows the last) in place of the second half, as many as that has, or all there are. Rows as
    in ``fingerprint_texts``; a single document follows itself; no documents give no rows.
    """
    keyed = _keyed(docs)
    ids = keyed.select("d1", "d2", "doc_id", F.char_length("text").cast("bigint").alias("n_chars")).distinct()
    following = stored(_next_keys(ids), "following")
    half = F.floor(F.col("n_chars") / 2).cast("int")
    # Each text is cut for the document before it, then meets the piece that it gets itself.
    before = following.select(F.col("n1").alias("d1"), F.col("n2").alias("d2"), F.col("d1").alias("p1"), F.col("d2").alias("p2"), half.alias("half"))
    # Repeated rows are dropped on arrival: below the aggregation the shuffle of pieces is found to be one and used again.
    cut = _by_key(keyed.select("d1", "d2", "text")).join(before, ["d1", "d2"])
    given = _by_key(cut.select(F.col("p1").alias("d1"), F.col("p2").alias("d2"), F.left("text", "half").alias("given"))).dropDuplicates(["d1", "d2"])
    own = F.char_length("text")
    both = _texts(keyed).join(given, ["d1", "d2"])
    both = both.select("d1", "d2", F.concat(F.left("text", own - F.floor(own / 2).cast("int")), "given").alias("edited"))
    facts = both.select("d1", "d2", F.sha2("edited", 256).alias("edited_sha256"))
    # Stored, so that it is drawn once and is one broadcast for both sketches below.
    frequent = stored(_frequent(keyed, samples), "frequent")
    edited = _sketches(both, ["d1", "d2"], "edited", samples, frequent).withColumnRenamed("signature", "edited_signature")
    # A text's signature is drawn once, for its own document and for the one before.
    drawn = _sketches(_texts(keyed), ["d1", "d2"], "text", samples, frequent).join(before.drop("half"), ["d1", "d2"])
    places = F.array(F.struct("d1", "d2", F.lit(False).alias("ahead")), F.struct(F.col("p1").alias("d1"), F.col("p2").alias("d2"), F.lit(True).alias("ahead")))
    sent = _by_key(drawn.select(F.explode(places).alias("place"), "signature").select("place.*", "signature"))
    signatures = sent.groupBy("d1", "d2").agg(
        F.max(F.when(~F.col("ahead"), F.col("signature"))).alias("signature"),
        F.max(F.when(F.col("ahead"), F.col("signature"))).alias("next_signature"),
    )
    known = facts.join(edited, ["d1", "d2"]).join(signatures, ["d1", "d2"]).join(following, ["d1", "d2"])
    return known.select("edited_sha256", "signature", "edited_signature", "doc_id", "n_chars", "next_signature")
