"""MinHash near-duplicates with tensored banding.

Two collections of `M` keys are made from `R` minhashes each; a table is made for each pair of a key of the first and a
key of the second collection. So M * M tables of 2 * R minhashes cost only 2 * M * R minhashes. Two texts of similarity
J meet in some table unless one collection has no key in common: with J = 0.8, R = 3 and M = 16 that happens to 21
of a million pairs, and to fewer still above. What meets is confirmed on the full sets. Keys that a single document has
leave before tables are made of pairs, so work follows the documents that share keys.

Texts with equal sets are one class and only its first document goes on. A bucket with more than `CROWD` documents is
split by a key of a third collection, which parts texts that share a frequent line rather than most of their text; a
pair at the threshold meets in some fifty tables, of which the split leaves about half; if all its buckets are split, it
meets in none with a probability of 3.9e-5. Every document is compared with
two others first: of all that anchor its buckets (the one of a bucket that meets most others in all tables, and the one
with the least id) the heaviest and the least. Buckets whose documents are in different components then compare all with
their own two anchors, and those that still are are searched for the missing links.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from lumisift.llm.components import components
from lumisift.llm.stored import stored
from lumisift.llm.workers import hold

#: Keys of a collection, minhashes of a key, documents of a bucket from which on it is split.
M, R, CROWD = 16, 3, 12
#: Bits of an odd sketch, a multiple of 64.
BITS = 1024
#: Bits of the table that thins texts before they are shuffled; bounds memory, never the result.
MARKS = 1 << 26
#: Words whose hashes a worker remembers; bounds memory, never the result.
REMEMBERED = 200_000


@functools.cache
def _words() -> dict[bytes, int]:
    return {}


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def shingle_hashes(text: str | None, width: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles of a text: A-Z in lower case, words between ASCII white space;
    fewer words than `width` make one shingle, none make none."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    known = _words()
    if len(known) > REMEMBERED:
        known.clear()
    try:
        codes = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
    except KeyError:
        for w in set(words):
            if w not in known:
                known[w] = xxhash.xxh3_64_intdigest(w)
        codes = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
    width = min(width, len(codes))
    n = len(codes) - width + 1
    out = np.full(n, width, np.uint64)
    for k in range(width):
        out = _mixed(out * np.uint64(0x9E3779B97F4A7C15) + codes[k : k + n])
    return np.unique(out)


def minhashes(hashes: np.ndarray) -> np.ndarray:
    """3 * M * R minhashes of a set that isn't empty, a bounded part of it at a time."""
    factors = _mixed(np.arange(1, 3 * M * R + 1, dtype=np.uint64)) | np.uint64(1)
    best = np.full(len(factors), np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(hashes), 4096):
        best = np.minimum(best, (hashes[None, i : i + 4096] * factors[:, None]).min(1))
    return best


def keys(best: np.ndarray) -> np.ndarray:
    """The keys of the three collections from the minhashes."""
    out = np.arange(1, 3 * M + 1, dtype=np.uint64)
    for part in best.reshape(3 * M, R).T:
        out = _mixed(out * np.uint64(0x9E3779B97F4A7C15) + part)
    return out.view(np.int64)


def odd_sketch(hashes: np.ndarray) -> np.ndarray:
    odd = np.bincount((hashes >> np.uint64(20)).astype(np.int64) % BITS, minlength=BITS) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def sketches(docs: DataFrame, width: int) -> DataFrame:
    """`id, n_shingles, digest, odd, first, second, third` of documents `id, text`; all after the size are null for empty sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hold("near_dedup", _words.cache_clear)
        for batch in batches:
            rows = []
            for text in batch.column(1):
                hashes = shingle_hashes(text.as_py(), width)
                if not len(hashes):
                    rows.append((0, *[None] * 5))
                    continue
                made = keys(minhashes(hashes))
                rows.append((len(hashes), hashlib.blake2b(hashes.tobytes(), digest_size=16).digest(), odd_sketch(hashes), made[:M], made[M : 2 * M], made[2 * M :]))
            kinds = [pa.int64(), pa.binary(), *[pa.list_(pa.int64())] * 4]
            made = [pa.array([row[i] for row in rows], kind) for i, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *made], ["id", "n_shingles", "digest", "odd", "first", "second", "third"])

    kind = docs.schema["id"].dataType.simpleString()
    return docs.mapInArrow(run, f"id {kind}, n_shingles bigint, digest binary, odd array<bigint>, first array<bigint>, second array<bigint>, third array<bigint>")


def _among(docs: DataFrame, asked: DataFrame) -> DataFrame:
    """The documents whose hashed id is marked in a table of `MARKS` bits, before their texts are shuffled: all that are
    asked for and a share of the others that is at most the share of bits that are marked. What follows must not be a
    semi-join, which the optimizer would move below this one."""
    mark = F.pmod(F.xxhash64(F.col("id").cast("string")), F.lit(MARKS))
    marked = asked.select(mark.alias("mark"))
    marked = marked.groupBy(F.expr("bitmap_bucket_number(mark)").alias("__part")).agg(F.expr("bitmap_construct_agg(bitmap_bit_position(mark))").alias("__bits"))
    own = docs.withColumn("__mark", mark)
    own = own.withColumn("__part", F.expr("bitmap_bucket_number(__mark)")).withColumn("__at", F.expr("bitmap_bit_position(__mark)").cast("int"))
    own = own.join(F.broadcast(marked), "__part")  # at most MARKS / 8 bytes
    byte = F.conv(F.hex(F.substring("__bits", F.shiftright("__at", 3) + 1, F.lit(1))), 16, 10).cast("int")
    return own.where(F.getbit(byte, F.col("__at") % 8) == 1).select("id", "text")


def confirmed(pairs: DataFrame, docs: DataFrame, width: int, percent: int) -> DataFrame:
    """Those pairs `a, b` of documents whose full sets are similar enough."""

    @pandas_udf("array<bigint>")
    def sets(texts: pd.Series) -> pd.Series:
        hold("near_dedup", _words.cache_clear)
        return pd.Series([shingle_hashes(text, width).view(np.int64) for text in texts], dtype=object)

    asked = pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct()
    full = _among(docs, asked).join(asked, "id").select("id", sets("text").alias("set"))
    right = full.select(F.col("id").alias("b"), F.col("set").alias("set_b"))
    left = full.select(F.col("id").alias("a"), F.col("set").alias("set_a"))
    both = pairs.join(right, "b").join(left, "a")
    common = F.size(F.array_intersect("set_a", "set_b"))
    both = both.select("a", "b", common.cast("long").alias("common"), (F.size("set_a") + F.size("set_b")).cast("long").alias("sizes"))
    return both.where(f"100 * common >= {percent} * (sizes - common)").select("a", "b").distinct()


def _tables(heads: DataFrame) -> DataFrame:
    """`id, bucket` of documents `id, first, second` in every table in which they can meet another one.

    A key that one document alone has is in no bucket of several, so such keys leave before pairs are made of them.
    A bucket's lowest bits say which third key it is split by if it is crowded.
    """
    each = heads.select("id", F.posexplode(F.concat("first", "second")).alias("n", "key"))  # a key tells its place too
    shared = each.groupBy("key").agg(F.count("*").alias("many")).where("many > 1").select("key")
    own = each.join(shared, "key", "left_semi").groupBy("id").agg(F.collect_list(F.struct("n", "key")).alias("own"))  # at most 2 * M
    first, second = F.filter("own", lambda k: k.n < M), F.filter("own", lambda k: k.n >= M)
    pairs = own.select("id", second.alias("second"), F.explode(first).alias("x")).select("id", "x", F.explode("second").alias("y"))
    split = F.pmod(F.col("x.n") + F.col("y.n"), F.lit(M))
    hashed = F.shiftleft(F.shiftright(F.xxhash64("x.key", "y.key"), 8), 8) + split
    return pairs.select("id", hashed.alias("bucket"))


def _ordered(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.least("id", "anchor").alias("a"), F.greatest("id", "anchor").alias("b")).distinct()


def _apart(known: DataFrame, roots: DataFrame) -> DataFrame:
    """`id, bucket, weight, root` in the buckets that hold documents of several components."""
    rooted = known.join(roots.withColumnRenamed("node", "id"), "id", "left").select("id", "bucket", "weight", F.coalesce("root", "id").alias("root"))
    rooted = stored(rooted, "rooted")
    apart = rooted.groupBy("bucket").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo <> hi").select("bucket")
    return stored(rooted.join(apart, "bucket", "left_semi"), "apart")


def near_duplicates(
    df: DataFrame, width: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text",
    confirm: Callable = confirmed,
) -> DataFrame:
    """For every document the size of its shingle set, the smallest id reachable over links of at least `percent`
    similarity, and whether that is its own: id, n_shingles, component_id, kept.

    Null and empty texts have no shingles and are linked with nothing. Rows with equal ids are one document of which
    each row is reported; a null id is linked with nothing. Other columns are left out; an empty table gives no rows.
    """
    docs = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    sketch = stored(sketches(docs, width), "sketches")
    full = sketch.where("digest is not null and id is not null")
    classes = full.groupBy("digest").agg(F.min("id").alias("head"))
    heads = full.join(classes.withColumnRenamed("digest", "of"), F.expr("digest = of and id = head"), "left_semi").select("id", "first", "second", "third")
    tables = _tables(heads)
    size = F.count("*").over(Window.partitionBy("bucket"))
    met = stored(tables.withColumn("size", size).where("size > 1"), "buckets")
    thirds = heads.select("id", "third")
    leaf = F.xxhash64("bucket", F.get("third", F.shiftrightunsigned(F.shiftleft("bucket", 56), 56).cast("int")))
    deeper = met.where(f"size > {CROWD}").join(thirds, "id").select("id", leaf.alias("bucket"))
    deeper = deeper.withColumn("size", size).where("size > 1")
    crowded = stored(met.where(f"size <= {CROWD}").select("id", "bucket", "size").union(deeper.select("id", "bucket", "size")), "leaves")
    weight = crowded.groupBy("id").agg(F.sum("size").alias("weight"))
    known = stored(crowded.join(weight, "id").select("id", "bucket", "weight"), "known")
    heavy, least = F.struct("weight", (-F.col("id")).alias("id")), F.min("id").alias("least")
    anchors = known.groupBy("bucket").agg(F.max(heavy).alias("most"), least)
    near = known.join(anchors, "bucket").groupBy("id").agg(F.max(F.when(F.col("most.id") != -F.col("id"), F.col("most"))).alias("most"), F.min(F.when(F.col("least") != F.col("id"), F.col("least"))).alias("least"))
    pairs = near.select("id", F.explode(F.array(-F.col("most.id"), F.col("least"))).alias("anchor")).where("anchor is not null")
    tried = stored(_ordered(pairs), "pairs")
    links = stored(confirm(tried, docs, width, percent), "links")
    rooted = _apart(known, components(links))
    anchors = rooted.groupBy("bucket").agg(F.max(F.struct("weight", (-F.col("id")).alias("id"), "root")).alias("most"), F.min(F.struct("id", "root")).alias("least"))
    pairs = rooted.join(anchors, "bucket").select("id", "root", F.explode(F.array(F.struct((-F.col("most.id")).alias("id"), F.col("most.root").alias("root")), "least")).alias("anchor"))
    more = stored(_ordered(pairs.where("root <> anchor.root").select("id", F.col("anchor.id").alias("anchor"))).join(tried, ["a", "b"], "left_anti"), "pairs")
    links, tried = stored(links.union(confirm(more, docs, width, percent)), "links"), tried.union(more)
    rooted = _apart(rooted.select("id", "bucket", "weight"), components(links))
    rooted = stored(rooted.join(full.select("id", "n_shingles", "odd").dropDuplicates(["id"]), "id").select("bucket", "id", "root", "n_shingles", "odd"), "apart")
    other = rooted.select("bucket", *(F.col(c).alias(a) for c, a in (("id", "b"), ("root", "root_b"), ("n_shingles", "n_b"), ("odd", "odd_b"))))
    differ = sum((F.bit_count(F.get("odd", i).bitwiseXOR(F.get("odd_b", i))) for i in range(BITS // 64)), F.lit(0))
    possible = differ * (100 + percent) <= (F.col("n_shingles") + F.col("n_b")) * (100 - percent)
    more = rooted.join(other, (rooted.bucket == other.bucket) & (F.col("root") < F.col("root_b")) & possible).select(F.least("id", "b").alias("a"), F.greatest("id", "b").alias("b")).distinct()
    more = stored(more.join(tried, ["a", "b"], "left_anti"), "pairs")
    links = stored(links.union(confirm(more, docs, width, percent)), "links")
    roots = components(links)
    classes = classes.join(roots, classes["head"] == roots.node, "left").select("digest", F.coalesce("root", "head").alias("root"))
    out = sketch.join(classes, "digest", "left").select("id", "n_shingles", F.coalesce("root", "id").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("id") == F.col("component_id"), F.lit(True))).withColumnRenamed("id", id_col)
