"""Document fingerprints: SimHash by DataFrame functions only.

Terms are the lower-case words of a text; each occurrence weighs as much as the word has characters. Two 64-bit hashes of a term
give 128 signed votes, so a bit of the fingerprint is set where the words whose hash has it outweigh the others. Bits ``i`` and
``i + 32`` of a hash share one sum, each in its own half, which makes 64 sums of 128 votes; all of it is generated code.

Fingerprints within a Hamming radius are found by permuted block tables: the bits are cut into ``radius + 1`` blocks and table
``t`` puts block ``t`` in front, so two fingerprints within the radius meet in at least one table by its leading block, and they are
compared where they meet first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from surestar.llm.common import store

BITS = 128
_HALVES = (1 << 32) + 1


def _vote_sums(term: Column, weight: Column) -> list[Column]:
    sums = []
    for h in range(2):
        for i in range(32):
            two = F.shiftrightunsigned(F.col(f"h{h}"), i).bitwiseAND(F.lit(_HALVES))
            sums.append(F.sum(two * F.col("weight")).alias(f"v{h}_{i}"))
    return sums


def _bits(half: int) -> Column:
    """64 bits of a fingerprint from the sums of one hash."""
    value = F.lit(0).cast("long")
    for i in range(32):
        total = F.col(f"v{half}_{i}")
        low, high = total.bitwiseAND(F.lit((1 << 32) - 1)), F.shiftrightunsigned(total, 32)
        for bit, votes in ((i, low), (i + 32, high)):
            set_bit = F.shiftleft(F.lit(1).cast("long"), bit)
            value = value.bitwiseOR(F.when(votes * 2 > F.col("votes"), set_bit).otherwise(F.lit(0).cast("long")))
    return value


def simhash(texts: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """``keys``, ``rows``, ``f0`` and ``f1`` of each different combination of ``keys`` (fixed-size columns that determine the text).

    ``rows`` counts the input rows. A text without words, and null, has fingerprint 0. The weights of a text may add up to 2^31.
    """
    words = F.split(F.lower(F.coalesce(F.col(text), F.lit(""))), r"[\x20\x09-\x0D]+")
    terms = texts.select(*keys, F.posexplode(words).alias("place", "term"))
    terms = terms.select(
        *keys, F.xxhash64("term").alias("h0"), F.xxhash64(F.lit(1), "term").alias("h1"), F.length("term").cast("long").alias("weight"),
        (F.col("place") == 0).cast("long").alias("first"),
    )
    summed = terms.groupBy(*keys).agg(F.sum("first").alias("rows"), F.sum("weight").alias("votes"), *_vote_sums(F.col("h0"), F.col("weight")))
    return summed.select(*keys, "rows", _bits(0).alias("f0"), _bits(1).alias("f1"))


def likeness(a: tuple[str, str], b: tuple[str, str]) -> Column:
    """Share of equal bits of two fingerprints, from 0 to 1."""
    differ = [F.bit_count(F.col(x).bitwiseXOR(F.col(y))) for x, y in zip(a, b, strict=True)]
    return 1 - (differ[0] + differ[1]) / F.lit(float(BITS))


def as_hex(f0: str, f1: str) -> Column:
    return F.lower(F.concat(F.lpad(F.hex(f0), 16, "0"), F.lpad(F.hex(f1), 16, "0")))


def _blocks(f0: Column, f1: Column, radius: int) -> list[Column]:
    """The blocks of a fingerprint as numbers; a block may reach over the middle."""
    parts, blocks = radius + 1, []
    for i in range(parts):
        low, high = BITS * i // parts, BITS * (i + 1) // parts
        pieces = []
        for start, word in ((0, f0), (64, f1)):
            a, b = max(low, start) - start, min(high, start + 64) - start
            if a < b:
                pieces.append(F.shiftrightunsigned(word, a) if b == 64 else F.shiftrightunsigned(word, a).bitwiseAND(F.lit((1 << (b - a)) - 1)))
        blocks.append(pieces[0] if len(pieces) == 1 else F.xxhash64(*pieces))
    return blocks


def within_radius(queries: DataFrame, index: DataFrame, radius: int = 3) -> DataFrame:
    """Pairs ``q0, q1, f0, f1`` of a query and an indexed fingerprint at most ``radius`` bits apart, each pair once.

    ``queries`` has ``q0, q1`` and ``index`` has ``f0, f1``; both hold different fingerprints, so equal texts are one row.
    """
    left, right = _blocks(F.col("q0"), F.col("q1"), radius), _blocks(F.col("f0"), F.col("f1"), radius)
    both = [F.posexplode(F.array(*x)).alias("table", "block") for x in (left, right)]
    met = queries.select("q0", "q1", both[0]).join(index.select("f0", "f1", both[1]), ["table", "block"])
    differ = F.bit_count(F.col("q0").bitwiseXOR(F.col("f0"))) + F.bit_count(F.col("q1").bitwiseXOR(F.col("f1")))
    earlier = F.lit(False)
    for t, (a, b) in enumerate(zip(left, right, strict=True)):
        earlier = earlier | ((F.lit(t) < F.col("table")) & (a == b))
    return met.where((differ <= radius) & ~earlier).select("q0", "q1", "f0", "f1")


def _next_buckets(nodes: DataFrame, levels: int) -> DataFrame:
    """``flag, b, next_flag, next_b``: the bucket that follows each one in order, the first after the last.

    Buckets are grouped by their leading bits, so that no window sees more than 2^16 of them; groups follow each other likewise.
    """
    if levels == 0:
        order = Window.partitionBy(F.lit(0)).orderBy("flag", "b")
        first = F.first(F.struct("flag", "b")).over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
        after = F.coalesce(F.lead(F.struct("flag", "b")).over(order), first)
        return nodes.withColumn("after", after).select("flag", "b", F.col("after.flag").alias("next_flag"), F.col("after.b").alias("next_b"))
    grouped = nodes.withColumn("g", F.shiftright("b", 16))
    after = F.lead("b").over(Window.partitionBy("flag", "g").orderBy("b"))
    grouped = store(grouped.withColumn("after", after))
    firsts = grouped.groupBy("flag", "g").agg(F.min("b").alias("next_b"))
    groups = _next_buckets(firsts.select("flag", F.col("g").alias("b")), levels - 1).withColumnRenamed("b", "g")
    firsts = firsts.select(F.col("flag").alias("next_flag"), F.col("g").alias("next_g"), "next_b")
    crossing = grouped.where("after IS NULL").join(groups.withColumnRenamed("next_b", "next_g"), ["flag", "g"]).join(firsts, ["next_flag", "next_g"])
    inside = grouped.where("after IS NOT NULL").select("flag", "b", F.col("flag").alias("next_flag"), F.col("after").alias("next_b"))
    return inside.unionByName(crossing.select("flag", "b", "next_flag", "next_b"))


def with_next(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``text``, ``next_id`` and ``next_text``: each document and the one that follows by id, the first after the last.

    Null texts are empty. Rows of one id stand by a hash of their texts; rows without id come last, by that hash. Ids are dealt
    to buckets of 512 neighbouring ones, so the texts are shuffled once and no task gets a share that grows.
    """
    text = F.coalesce("text", F.lit(""))
    base = docs.select("doc_id", text.alias("text"), F.col("doc_id").isNull().cast("int").alias("flag"), F.coalesce("doc_id", F.xxhash64(text)).alias("k"))
    base = base.withColumn("b", F.shiftright("k", 9))
    order = Window.partitionBy("flag", "b").orderBy("k", F.xxhash64("text"))
    rows = base.withColumns({"next_text": F.lead("text").over(order), "next_id": F.lead("doc_id").over(order), "place": F.row_number().over(order)})
    buckets = store(base.select("flag", "b").distinct())
    follow = store(_next_buckets(buckets, 3))
    firsts = rows.where("place = 1").select(
        F.col("flag").alias("next_flag"), F.col("b").alias("next_b"), F.col("text").alias("next_text"), F.col("doc_id").alias("next_id")
    )
    lasts = rows.where("next_text IS NULL").select("doc_id", "text", "flag", "b")
    lasts = lasts.join(follow, ["flag", "b"]).join(firsts, ["next_flag", "next_b"])
    columns = ["doc_id", "text", "next_id", "next_text"]
    return rows.where("next_text IS NOT NULL").select(columns).unionByName(lasts.select(columns))


def edited_fingerprints(docs: DataFrame, radius: int = 3) -> DataFrame:
    """Fingerprints of all texts and of their edited texts, whose last half is the beginning of the next document.

    One row per row of ``docs`` (``doc_id``, ``text``): ``doc_id``, ``n_chars``, ``edited_sha256``, ``fingerprint``,
    ``edited_fingerprint``, ``near_edited``, ``near_next`` and ``edited_hits``, the number of rows whose fingerprint is at most ``radius``
    bits from that of the edited text. A single document is its own next one; an empty table gives no rows.
    """
    pairs = with_next(docs)
    length = F.length("text")
    half = F.floor(length / 2).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), length - half), F.substring("next_text", F.lit(1), half))
    pairs = pairs.select(
        "doc_id", length.cast("long").alias("n_chars"), F.xxhash64("text").alias("text_hash"), F.xxhash64("next_text").alias("next_hash"), "text", edited.alias("edited")
    )
    digest = F.sha2("edited", 256)
    quarters = [F.conv(F.substring(digest, 16 * i + 1, 16), 16, -10).cast("long").alias(f"s{i}") for i in range(4)]
    keys = ["doc_id", "n_chars", "text_hash", "next_hash", "s0", "s1", "s2", "s3"]
    kinds = F.posexplode(F.array("text", "edited")).alias("kind", "text")
    both = pairs.select("doc_id", "n_chars", "text_hash", "next_hash", *quarters, kinds)
    marked = simhash(both, [*keys, "kind"])
    pick = [F.max(F.when(F.col("kind") == k, F.col(f))).alias(n) for k, names in ((0, ("f0", "f1")), (1, ("q0", "q1"))) for f, n in zip(("f0", "f1"), names, strict=True)]
    marked = store(marked.groupBy(*keys).agg(F.max("rows").alias("rows"), *pick))

    # written, so that the join below is one that Spark can split where many documents have the same next text
    texts = store(marked.groupBy(F.col("text_hash").alias("next_hash")).agg(F.min("f0").alias("n0"), F.min("f1").alias("n1")))
    index = marked.groupBy("f0", "f1").agg(F.sum("rows").alias("n"))
    found = within_radius(marked.select("q0", "q1").distinct(), index.select("f0", "f1"), radius)
    hits = found.join(index, ["f0", "f1"]).groupBy("q0", "q1").agg(F.sum("n").alias("hits"))
    rows = marked.join(texts, "next_hash").join(hits, ["q0", "q1"], "left").withColumn("copy", F.explode(F.array_repeat(F.lit(0), F.col("rows").cast("int"))))
    return rows.select(
        "doc_id", "n_chars", F.lower(F.concat(*[F.lpad(F.hex(f"s{i}"), 16, "0") for i in range(4)])).alias("edited_sha256"),
        as_hex("f0", "f1").alias("fingerprint"), as_hex("q0", "q1").alias("edited_fingerprint"),
        likeness(("f0", "f1"), ("q0", "q1")).alias("near_edited"), likeness(("f0", "f1"), ("n0", "n1")).alias("near_next"),
        F.coalesce("hits", F.lit(0)).cast("long").alias("edited_hits"),
    )
