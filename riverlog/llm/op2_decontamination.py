"""Benchmark decontamination by winnowing, with DataFrame functions only.

Texts become word arrays. Each run of K consecutive words has a hash; of each W consecutive hashes the least is kept, with
its place (K + W - 1 = WINDOW words, so two texts that share WINDOW words in a row keep a common hash from inside the shared
part). Kept hashes of documents are joined with those of items; each hit is extended, word by word, to the longest shared
span around it, and spans of WINDOW words or more count. Items of fewer words than WINDOW take part with one hash over all
their words, against every run of that many words in documents.

The corpus is read once and never shuffled: the joined side are the items' fingerprints, broadcast when their measured bytes
are within BROADCAST_BYTES; beyond it the document words are stored, fingerprints are shuffled and matching documents fetched by row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riverlog.llm.common import let, lower_ascii, stored, table

#: Characters that end a word: fixed value.
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WINDOW, K = 13, 5
W = WINDOW - K + 1
assert W == 9  # winnow() takes the least of 3 of the least of 3
#: A key holds a hash in its high bits and a word's place in the low ones; no text has more words than Spark's 2 GB allow.
PLACE_BITS = 30
BROADCAST_BYTES = 8 << 20
#: The key that stands for a document itself in the join, so that documents without hits stay.
SELF = 0


def words(text: Column) -> Column:
    """Only the first and the last part of a split can be empty."""
    cut = F.split(lower_ascii(F.coalesce(text, F.lit(""))), GAP)

    def trimmed(x: Column) -> Column:
        first = F.when(F.get(x, F.lit(0)) == "", 2).otherwise(1)
        last = F.when((F.size(x) > 1) & (F.element_at(x, -1) == ""), F.size(x) - 1).otherwise(F.size(x))
        return F.slice(x, first, F.greatest(F.lit(0), last - first + 1))

    return let(cut, trimmed)


def _key(h: Column, i: Column) -> Column:
    """Ordered by hash, then by the last place first."""
    mask = (1 << PLACE_BITS) - 1
    return h.bitwiseAND(F.lit(~mask)).bitwiseOR(F.lit(mask) - i)


def _hash_of(key: Column) -> Column:
    return F.shiftright(key, PLACE_BITS)


def _place_of(key: Column) -> Column:
    mask = (1 << PLACE_BITS) - 1
    return (F.lit(mask) - key.bitwiseAND(F.lit(mask))).cast("int")


def _range(n: Column) -> Column:
    """0 .. n-1, empty for n < 1."""
    return F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))


def grams(h: Column, k: int) -> Column:
    """Keys of all runs of k word hashes."""
    return F.transform(_range(F.size(h) - (k - 1)), lambda i: _key(F.xxhash64(F.lit(k), *[F.get(h, i + j) for j in range(k)]), i.cast("long")))


def winnow(h: Column) -> Column:
    """Keys of the least hash of each WINDOW words."""
    least3 = lambda g, step: F.transform(_range(F.size(g) - 2 * step), lambda i: F.least(F.get(g, i), F.get(g, i + step), F.get(g, i + 2 * step)))
    return let(grams(h, K), lambda g: let(least3(g, 1), lambda m: F.array_distinct(least3(m, 3))))


def fingerprints(ws: Column, lengths: list[int]) -> Column:
    """array<long>: winnowed keys, and the keys of every run of k words for each short item length k."""
    return let(F.transform(ws, lambda w: F.xxhash64(w)), lambda h: F.concat(winnow(h), *[grams(h, k) for k in lengths]))


def _span(dw: Column, p: Column, iw: Column, q: Column) -> Column:
    """struct(b, e): the longest shared span of document and item words around places p and q, as document places."""
    same = lambda j: F.get(dw, p + j) == F.get(iw, q + j)
    before = F.least(p, q)
    after = F.least(F.size(dw) - p, F.size(iw) - q)
    stop = lambda n, f: F.coalesce(F.array_min(F.filter(_range(n), lambda j: ~f(j))), n)
    return F.struct((p - stop(before, lambda j: same(-1 - j))).alias("b"), (p + stop(after, same)).alias("e"))


def decontaminate(docs: DataFrame, items: DataFrame, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """For each row of docs(doc_id, text): doc_id, n_words, n_hit, item_ids (those found, sorted as strings), contaminated.

    Only those columns and items(item_id, text) are read. A null or empty text has no words; it is never contaminated, as an
    item it matches nothing. Rows that repeat a doc_id are each judged; repeated items count once. No items: no hits. Items of
    null item_id hit like others; all of them together are one null in item_ids, which stands last.
    """
    items = items.select(F.col("item_id").cast("string").alias("item_id"), words(F.col("text")).alias("iw")).where(F.size("iw") > 0)
    stats = items.agg(F.collect_set(F.when(F.size("iw") < WINDOW, F.size("iw"))).alias("short"), F.sum(F.octet_length(F.array_join("iw", " ")) + 64 * F.size("iw")).alias("bytes")).first()
    lengths = sorted(stats["short"])
    need = F.least(F.size("iw"), F.lit(WINDOW))
    index = (
        items.withColumn("keys", fingerprints(F.col("iw"), lengths))
        .withColumn("key", F.explode_outer("keys"))
        .select("item_id", "iw", _hash_of(F.col("key")).alias("h"), _place_of(F.col("key")).alias("q"))
        .distinct()
    )
    small = (stats["bytes"] or 0) * 4 <= broadcast_bytes
    base = docs.select("doc_id", words(F.col("text")).alias("dw")).withColumn("row", F.monotonically_increasing_id())
    base = base.withColumn("n_words", F.size("dw").cast("long"))
    if not small:  # row numbers are read in several branches, and must be the same in all of them, also in a task run again
        base = stored(base, "document-words")
    # A column of its own, so that explode runs in generated code and copies no words for keys that meet nothing; outer,
    # as else the optimizer filters by the array's size and so computes it twice.
    keyed = base.withColumn("keys", F.concat(F.array(F.lit(SELF)), fingerprints(F.col("dw"), lengths))).withColumn("key", F.explode_outer("keys"))
    keyed = keyed.select("row", "doc_id", "n_words", "dw", _hash_of(F.col("key")).alias("h"), F.when(F.col("key") != SELF, _place_of(F.col("key"))).alias("p"))
    span = F.when(F.col("p").isNotNull() & F.col("q").isNotNull(), _span(F.col("dw"), F.col("p"), F.col("iw"), F.col("q")))
    if small:
        self_row = index.sparkSession.range(1).select(F.lit(None).cast("string").alias("item_id"), F.lit(None).cast("array<string>").alias("iw"), F.lit(SELF >> PLACE_BITS).cast("long").alias("h"), F.lit(None).cast("int").alias("q"))
        met = keyed.join(F.broadcast(index.unionByName(self_row)), "h").withColumn("s", span)
        # No filter here: it would become part of the join, which would then leave generated code and copy each row's words.
        # A hit that is too short turns into one more row for the document itself.
        good = (F.col("s.e") - F.col("s.b")) >= need
        hits = met.select("row", "doc_id", "n_words", F.when(good, F.struct("item_id")).alias("item"), F.when(good, F.col("s.b")).alias("b"), F.when(good, F.col("s.e")).alias("e"))
    else:
        # An item is found again by its id, which may be null, and a hash of its words.
        met = keyed.where("p IS NOT NULL").drop("dw").join(index.select("h", "q", F.col("item_id").alias("id"), F.xxhash64("iw").alias("ih")), "h").select("row", "id", "ih", "p", "q").distinct()
        full = met.join(base.select("row", "dw"), "row").join(items.distinct(), F.col("id").eqNullSafe(F.col("item_id")) & (F.col("ih") == F.xxhash64("iw"))).withColumn("s", span)
        spans = full.where(F.col("s.e") - F.col("s.b") >= need).select("row", F.struct("item_id").alias("item"), F.col("s.b").alias("b"), F.col("s.e").alias("e"))
        hits = base.select("row", "doc_id", "n_words").join(spans, "row", "left")
    # First one row for each span, then spans of a document are united in order: no more than the document has places.
    spans = hits.groupBy("row", "doc_id", "n_words", "b", "e").agg(F.collect_set("item").alias("ids"))
    per = spans.groupBy("row", "doc_id", "n_words").agg(F.array_sort(F.collect_list(F.when(F.col("b").isNotNull(), F.struct("b", "e")))).alias("spans"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("ids"))["item_id"])).alias("item_ids"))
    zero = F.struct(F.lit(0).alias("n"), F.lit(0).alias("to"))
    hit = F.aggregate("spans", zero, lambda a, s: F.struct((a["n"] + F.greatest(F.lit(0), s["e"] - F.greatest(s["b"], a["to"]))).alias("n"), F.greatest(a["to"], s["e"]).alias("to")), lambda a: a["n"].cast("long"))
    return per.select("doc_id", "n_words", hit.alias("n_hit"), "item_ids").withColumn("contaminated", (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words")))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return got.select("doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"), F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"), "contaminated")


#: Every place of every document against every window of every item.
ORACLE = r"""
WITH d AS MATERIALIZED (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
i AS MATERIALIZED (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
iw AS (SELECT item_id, least(len(w), 13) AS n, unnest(list_transform(range(1, len(w) - least(len(w), 13) + 2), lambda p: array_to_string(w[p:p + least(len(w), 13) - 1], ' '))) AS s FROM i WHERE len(w) > 0),
n AS (SELECT DISTINCT n FROM iw),
dw AS (SELECT doc_id, n, unnest(range(1, len(w) - n + 2)) AS p, unnest(list_transform(range(1, len(w) - n + 2), lambda p: array_to_string(w[p:p + n - 1], ' '))) AS s FROM d, n WHERE len(w) >= n),
hit AS MATERIALIZED (SELECT DISTINCT doc_id, p, dw.n, CAST(item_id AS VARCHAR) AS item_id FROM dw JOIN iw ON dw.s = iw.s AND dw.n = iw.n),
places AS (SELECT doc_id, count(DISTINCT x) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + n)) AS x FROM hit) GROUP BY doc_id),
ids AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS s FROM (SELECT DISTINCT doc_id, item_id FROM hit) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
  sha256(coalesce(s, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN places USING (doc_id) LEFT JOIN ids USING (doc_id)
"""

QUERIES = {"op2_decontamination": op2_decontamination}
ORACLES = {"op2_decontamination": ORACLE}
