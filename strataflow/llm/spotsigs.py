"""Document fingerprints by spot signatures, with DataFrame functions only.

At every anchor, a very common word, a chain of the next content words (words that are no anchors) makes one
signature. The set of a document's signatures is its fingerprint: text around the anchors is running prose, while
navigation and lists have none. Fingerprints are compared by the Jaccard similarity of their sets, and only if
their sizes allow it.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strataflow.llm.components import components
from strataflow.session import stage

# Anchors, common function words of English, German, French and Spanish.
ANCHORS = (
    "a an and are as at be by for from has he in is it its of on or that the this to was were will with "
    "als auch auf das dem den der des die ein eine er es für im ist mit nicht sich sie und von zu "
    "au avec ce dans de des du elle en est et il la le les ne par pas pour qui sur un une "
    "al como con del el ella en es la las lo los más no para pero por se su una y"
).split()
CHAIN = 2
THRESHOLD = 0.75
# Segments of keys with as many rows each.
SEGMENTS = 256
#: Words of every text, as the whole library splits them.
GAP = r"[\x20\x09-\x0D]+"


def any_of(words: Iterable[str]) -> str:
    """A pattern of these words that branches letter by letter, so that a text's word is read once."""
    tails: dict[str, set[str]] = {}
    for word in words:
        tails.setdefault(word[:1], set()).add(word[1:])
    ends = "" in tails
    branches = [re.escape(first) + any_of(rest) for first, rest in sorted(tails.items()) if first]
    if not branches:
        return ""
    return f"(?:{'|'.join(branches)}){'?' if ends else ''}" if ends or len(branches) > 1 else branches[0]


def pattern(anchors: Iterable[str] = ANCHORS, chain: int = CHAIN) -> str:
    """A zero-width match at each anchor that captures it with its chain, the anchors between included."""
    word = any_of(anchors)
    skip = f"(?: {word}(?= ))*+"
    return f"(?<![^ ])(?=({word}(?:{skip} [^ ]++){{{chain}}}))"


def with_signatures(df: DataFrame, text: str, column: str, anchors: Iterable[str] = ANCHORS, chain: int = CHAIN) -> DataFrame:
    """Add the sorted distinct signatures of a whole text (null: empty) as 64-bit hashes.

    A text without a complete chain, which is short or has no anchors, has the hash of all its words as its only
    signature, so that equal texts have equal fingerprints and different short texts different ones.
    """
    # A column for each step, as Spark would compute a step again wherever its expression stands.
    plain = F.trim(F.regexp_replace(F.lower(F.coalesce(F.col(text), F.lit(""))), GAP, " "))
    spots = F.regexp_extract_all(F.col("__plain"), F.lit(pattern(anchors, chain)), F.lit(1))
    between = f" {any_of(anchors)}(?= )"
    hashes = F.transform("__spots", lambda s: F.xxhash64(F.regexp_replace(s, between, "")))
    whole = F.array(F.xxhash64("__plain", F.lit("all")))
    sigs = F.when(F.size("__spots") > 0, F.array_sort(F.array_distinct(hashes))).otherwise(whole)
    return df.withColumn("__plain", plain).withColumn("__spots", spots).withColumn(column, sigs).drop("__plain", "__spots")


def printed(sigs: Column) -> Column:
    """A fingerprint as text: its signatures in hexadecimal, in order."""
    return F.array_join(F.transform(sigs, lambda s: F.lpad(F.lower(F.hex(s)), 16, "0")), "")


def likeness(a: Column, b: Column) -> Column:
    """Jaccard similarity of two fingerprints, 0 to 1; null if one is null."""
    both = F.size(F.array_intersect(a, b))
    return both.cast("double") / (F.size(a) + F.size(b) - both)


def ranges(df: DataFrame, key: str, spread: int) -> tuple[Column, int]:
    """The number of a row's range of keys, and that of the highest key: about `spread` rows a range; null keys are -1.

    Approximate quantiles part the keys into up to SEGMENTS segments of as many rows, whatever gaps the keys have, and
    arithmetic parts each segment evenly.
    """
    quantiles = F.percentile_approx(key, [i / SEGMENTS for i in range(1, SEGMENTS)], 100 * SEGMENTS)
    low, high, rows, marks = df.agg(F.min(key), F.max(key), F.count(F.lit(1)), quantiles).first()
    if low is None:
        return F.lit(-1).cast("long"), -1
    segments = min(SEGMENTS, max(1, rows // spread))
    borders = sorted({m for i in range(1, segments) if low < (m := marks[i * SEGMENTS // segments - 1]) <= high})
    starts, ends = [low, *borders], [*[m - 1 for m in borders], high]
    each = max(1, -(-rows // (spread * len(starts))))
    widths = [-(-(end - start + 1) // each) for start, end in zip(starts, ends, strict=True)]

    def segment(first: int, last: int) -> Column:  # by halves, so that a row is held against few borders
        if first == last:
            return F.lit(first)
        half = (first + last) // 2
        return F.when(F.col(key) < borders[half], segment(first, half)).otherwise(segment(half + 1, last))

    own = segment(0, len(borders))
    at = [F.element_at(F.array(*[F.lit(x).cast("long") for x in xs]), own + 1) for xs in (starts, widths)]
    number = own.cast("long") * each + F.call_function("div", F.col(key) - at[0], at[1])
    top = len(borders) * each + min(each - 1, (high - starts[-1]) // widths[-1])
    return F.coalesce(number, F.lit(-1).cast("long")), top


def successor(
    df: DataFrame, key: str, text: str, derive: Callable[[DataFrame], DataFrame], added: list[str], spread: int = 2048
) -> DataFrame:
    """Add the columns that `derive` adds, and next_<column> of the text and of these from the row that follows.

    Rows follow in descending order of `key`; after the last comes the first. They are cut into ranges of the key with
    some `spread` rows each, and a window runs inside each. Only the last row of a range needs the first of the
    one below: those heads, one per range, are joined in by its number. Equal keys follow in the order of the text;
    rows without a key come last of all.
    """
    span, top = ranges(df, key, spread)
    inside = Window.partitionBy("__range").orderBy(F.col(key).desc_nulls_last(), F.col(text))
    carried = [text, *added]
    following = F.struct(*[F.col(c).alias(f"next_{c}") for c in carried])
    ranged = df.select(F.col(key), F.col(text), span.alias("__range"))
    placed = derive(ranged).withColumn("__next", F.lead(following).over(inside))
    # Which range follows is found on the numbers alone; of the texts only the heads are read for it.
    down = Window.orderBy(F.col("__range").desc())
    chain = ranged.select("__range").distinct()
    chain = chain.select("__range", F.coalesce(F.lead("__range").over(down), F.lit(top)).alias("__below"))
    heads = ranged.withColumn("__rank", F.row_number().over(inside)).filter("__rank = 1")
    heads = derive(heads).select(F.col("__range").alias("__below"), following.alias("__head"))
    borders = chain.join(heads, "__below").select("__range", "__head")
    after = F.coalesce("__next", "__head")
    joined = placed.join(borders, "__range", "left")
    return joined.select(key, *carried, *[after[f"next_{c}"].alias(f"next_{c}") for c in carried])


def matches(
    df: DataFrame, key: str = "doc_id", text: str = "text", *, threshold: float = THRESHOLD, anchors: Iterable[str] = ANCHORS, chain: int = CHAIN
) -> DataFrame:
    """One row per key: key, n_signatures, class_id (least key whose fingerprint is reachable by links of `threshold`).

    Fingerprints are partitioned by the length of their sets, so that a link can only join neighbouring partitions;
    inside them, sets that share one of their rarest signatures are compared, unless their lengths already rule it
    out. Equal fingerprints are one candidate. Rows with a null key are left out; a null text is empty.
    """
    sets = df.filter(F.col(key).isNotNull()).select(F.col(key).alias("id"), F.col(text).alias("t"))
    sets = with_signatures(sets, "t", "sigs", anchors, chain).drop("t")
    sets = stage(sets.withColumn("print", F.sha2(printed(F.col("sigs")), 256)), "spots")
    classes = sets.groupBy("print").agg(F.min("id").alias("rep"), F.first("sigs").alias("sigs"))
    classes = stage(classes.withColumn("n", F.size("sigs")), "spot-classes")
    # Partition p holds the lengths from base^p up to base^(p + 1), base = 1 / threshold.
    part = F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(1 / threshold))).cast("int")
    posted = classes.select("rep", "n", part.alias("part"), F.explode("sigs").alias("sig"))
    often = posted.groupBy("sig").agg(F.count(F.lit(1)).alias("df")).filter("df > 1")
    rare = Window.partitionBy("rep").orderBy("df", "sig")
    ranked = posted.join(often, "sig", "left").withColumn("df", F.coalesce("df", F.lit(1)))
    ranked = ranked.withColumn("place", F.row_number().over(rare))
    leading = ranked.filter((F.col("place") <= F.col("n") - F.ceil(F.col("n") * threshold) + 1) & (F.col("df") > 1))
    leading = stage(leading.select("rep", "n", "part", "sig"), "spot-leading")
    other = leading.select(F.col("rep").alias("b"), F.col("n").alias("n_b"), F.col("part").alias("part_b"), "sig")
    near = F.abs(F.col("part") - F.col("part_b")) <= 1
    fits = F.least("n", "n_b") >= threshold * F.greatest("n", "n_b")
    pairs = leading.join(other, "sig").filter((F.col("rep") < F.col("b")) & near & fits).select(F.col("rep").alias("a"), "b").distinct()
    one, two = classes.select(F.col("rep").alias("a"), F.col("sigs").alias("x")), classes.select(F.col("rep").alias("b"), F.col("sigs").alias("y"))
    links = pairs.join(one, "a").join(two, "b").filter(likeness(F.col("x"), F.col("y")) >= threshold).select("a", "b")
    tops = components(links, "spot-components").toDF("rep", "top")
    told = sets.join(classes.select("print", "rep", "n"), "print").join(tops, "rep", "left")
    return told.select(F.col("id").alias(key), F.col("n").alias("n_signatures"), F.coalesce("top", "rep").alias("class_id"))


def edited_likeness(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Each text's fingerprint, held against that of an edited copy and of the next document.

    Returns key, n_chars (code points), edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next. The
    edited copy has its last floor(n_chars / 2) code points replaced by the first as many (or all) of the next
    document's, in descending order of the key (after the last: the first). Texts that are null count as empty;
    repeated keys follow each other by text; a table of one row is its own successor; an empty one gives an empty one.
    """
    rows = df.select(F.col(key).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("t"))
    rows = successor(rows, "id", "t", lambda d: with_signatures(d, "t", "sigs"), ["sigs"])
    n = F.char_length("t").cast("long")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substring(F.col("t"), F.lit(1), (n - half).cast("int")), F.substring(F.col("next_t"), F.lit(1), half))
    rows = rows.select("id", n.alias("n_chars"), "sigs", "next_sigs", edited.alias("edited"))
    rows = with_signatures(rows, "edited", "edited_sigs")
    return rows.select(
        F.col("id").alias(key),
        "n_chars",
        F.sha2(F.encode("edited", "UTF-8"), 256).alias("edited_sha256"),
        printed(F.col("sigs")).alias("fingerprint"),
        printed(F.col("edited_sigs")).alias("edited_fingerprint"),
        likeness(F.col("sigs"), F.col("edited_sigs")).alias("near_edited"),
        likeness(F.col("sigs"), F.col("next_sigs")).alias("near_next"),
    )
