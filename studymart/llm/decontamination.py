"""Benchmark items inside documents: size-partitioned MinHash containment, verified exactly.

Only DataFrame functions. An item's sketch holds its smallest shingle hashes. How many depends on
the item's size class: so many that a document that holds the asked share of the item's shingles
must hold one of the sketch, by the pigeonhole principle. Documents aren't sketched, so their length
costs no recall. Each candidate pair is then verified on the shingles themselves.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from studymart.session import materialise

SHINGLE_WORDS = 5
CONTAINMENT = 0.8
#: A side is broadcast only if its rows, written as JSON, were measured to take at most so many bytes.
BROADCAST_BYTES = 32 << 20


def words(text: Column) -> Column:
    """Lower-case runs of letters and digits; none for null."""
    found = F.split(F.lower(F.coalesce(text.cast("string"), F.lit(""))), r"[^\p{L}\p{N}]+")
    return F.filter(found, lambda w: w != "")


def _starts(found: Column, n: int) -> Column:
    """Where shingles start; nowhere in a text of fewer words."""
    starts = F.sequence(F.lit(0), F.size(found) - n)
    return F.when(F.size(found) >= n, starts).otherwise(F.array().cast("array<int>"))


def shingles(found: Column, n: int) -> Column:
    return F.transform(_starts(found, n), lambda i: F.array_join(F.slice(found, i + 1, n), " "))


def shingle_hashes(found: Column, n: int) -> Column:
    """As ``shingles``, hashed word by word."""
    return F.transform(_starts(found, n), lambda i: F.xxhash64(*[F.get(found, i + k) for k in range(n)]))


def _by_length(found: Column, length: Column, lengths: list[int], shingled) -> Column:
    """The shingles of each row's own length."""
    out = F.when(length == lengths[0], shingled(found, lengths[0]))
    for n in lengths[1:]:
        out = out.when(length == n, shingled(found, n))
    return out


def bounded(side: DataFrame, most: int = BROADCAST_BYTES) -> DataFrame:
    """Marks a stored side for broadcast if its measured size is small enough, whatever its rows hold."""
    size = side.agg(F.sum(F.octet_length(F.to_json(F.struct("*"))).cast("long"))).first()[0]
    return F.broadcast(side) if (size or 0) <= most else side


def sketches(items: DataFrame, lengths: list[int], containment: float) -> DataFrame:
    """(hash, key, least): the hashes that give an item away, and the shingles a holder has at least.

    ``items`` has a row for each different text: its key, its words and the words of its shingles.
    """
    hashed = F.array_distinct(_by_length(F.col("words"), F.col("n"), lengths, shingle_hashes))
    hashes = items.select("key", hashed.alias("hashes")).select("key", F.size("hashes").alias("size"), F.explode("hashes").alias("hash"))
    by_item = Window.partitionBy("key").orderBy("hash")
    ranked = hashes.withColumn("rank", F.row_number().over(by_item))
    # The largest size of the class decides for all of the class: it needs the largest sketch.
    largest = F.pow(F.lit(2.0), F.floor(F.log2("size")) + 1) - 1
    kept = F.floor(largest * (1 - containment) + 1e-9) + 1
    least = F.ceil(F.col("size") * containment - 1e-9)
    return ranked.filter(F.col("rank") <= kept).select("hash", "key", least.alias("least"))


def contained_items(
    docs: DataFrame,
    items: DataFrame,
    containment: float = CONTAINMENT,
    n: int = SHINGLE_WORDS,
    doc_id: str = "doc_id",
    doc_text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """Pairs of a document and an item of whose distinct shingles it holds at least ``containment``.

    Columns doc_id, item_id, n_shingles (of the item), n_matched, containment. Texts are compared as
    lower-case letters and digits. An item of fewer than ``n`` words is one shingle of its own
    length, and documents are cut into shingles of each length that some item has: so short items
    are found inside long documents as well. Null and empty texts have no words and match nothing;
    texts may be of any length. Null ids are ids like any other; each row of an id, on both sides, is
    judged by itself and the best counts. Repeated rows add nothing; empty tables give no pairs.
    """
    cut = items.select(F.col(item_id).alias("item_id"), words(F.col(item_text)).alias("words")).filter(F.size("words") > 0)
    own = F.least(F.size("words"), F.lit(n)).alias("n")
    named = materialise(cut.select("item_id", F.sha2(F.array_join("words", " "), 256).alias("key"), "words", own), "items")
    different = named.dropDuplicates(["key"])
    lengths = sorted(r.n for r in different.select("n").distinct().collect()) or [n]
    sketch = materialise(sketches(different, lengths, containment), "item_sketches")
    texts = docs.select(F.col(doc_id).alias("doc_id"), F.col(doc_text).alias("text"))

    # The words are a column of their own: inside a lambda they would be cut again for every shingle.
    cut = texts.select("doc_id", words(F.col("text")).alias("words"))
    hashes = cut.select("doc_id", F.concat(*[shingle_hashes(F.col("words"), k) for k in lengths]).alias("hashes"))
    # Outer, as the optimizer would otherwise test every array for being empty, on a copy of the lambda.
    probes = hashes.select("doc_id", F.size("hashes").alias("n_hashes"), F.explode_outer("hashes").alias("hash"))
    found = probes.join(bounded(sketch), "hash").filter(F.col("n_hashes") >= F.col("least"))
    pairs = found.select("doc_id", "key").distinct()
    candidates = materialise(pairs.groupBy("doc_id").agg(F.collect_set("key").alias("keys")), "item_candidates")

    # Verification: on the whole texts of the candidates, shingle by shingle.
    shingled = F.array_distinct(_by_length(F.col("words"), F.col("n"), lengths, shingles))
    item_shingles = materialise(different.select("key", "n", shingled.alias("item_shingles")), "item_shingles")
    wanted = candidates.withColumnRenamed("doc_id", "id")
    held = texts.join(bounded(wanted), F.col("doc_id").eqNullSafe(F.col("id")))
    held = held.select("doc_id", "keys", words(F.col("text")).alias("words"))
    held = held.select("doc_id", "keys", *[F.array_distinct(shingles(F.col("words"), k)).alias(f"doc_{k}") for k in lengths])
    one = held.select("doc_id", *[f"doc_{k}" for k in lengths], F.explode("keys").alias("key"))
    compared = one.join(bounded(item_shingles), "key")
    matched = _by_length(F.col("item_shingles"), F.col("n"), lengths, lambda c, k: F.array_intersect(c, F.col(f"doc_{k}")))
    counted = compared.select(
        "doc_id",
        "key",
        F.size("item_shingles").cast("long").alias("n_shingles"),
        F.size(matched).cast("long").alias("n_matched"),
    ).filter(F.col("n_matched") >= F.ceil(F.col("n_shingles") * containment - 1e-9))
    counted = counted.distinct().join(bounded(named.select("item_id", "key").distinct()), "key")
    by_share = F.struct((F.col("n_matched") / F.col("n_shingles")).alias("share"), "n_matched", "n_shingles")
    best = counted.groupBy("doc_id", "item_id").agg(F.max(by_share).alias("best"))
    return best.select(
        "doc_id",
        "item_id",
        "best.n_shingles",
        "best.n_matched",
        (F.col("best.n_matched") / F.col("best.n_shingles")).alias("containment"),
    )


def without_items(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """The documents that hold no item; columns as they are."""
    held = contained_items(docs, items, **options).select(F.col("doc_id").alias("held_id")).distinct()
    name = options.get("doc_id", "doc_id")
    return docs.join(held, docs[name].eqNullSafe(held["held_id"]), "left_anti")
