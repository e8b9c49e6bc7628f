"""Benchmark decontamination: a positional inverted index of the words that benchmark windows need.

DataFrame functions only. A window is ``window`` consecutive words of an item; an item of fewer
words is one window. Steps:

1. distinct windows of all items, with the items that hold them;
2. how often each of their words occurs in the whole corpus (a partial count on the map side), and
   of each window its two rarest words with their offsets, the pivot and the partner; windows with a
   word that never occurs are out;
3. the index: the postings (document, term, position) of pivots and partners, those of pivots with
   the words around, written to the shared folder, and one more for each document's end;
4. the lists of each pair of pivot and partner are intersected, adjusted by their offsets: both must
   stand as they do in the window or, for proximity, within ``slop`` words of each other. Lists meet
   by document, term and a cell of positions, so no list is in one task;
5. where lists meet, the other words of the window are held against those around the pivot: in a
   phrase match they stand in order; in a proximity match all are within ``slop`` words of the pivot;
6. matches are gathered by document, as sets of spans.

Tables of benchmark terms, pairs and windows are broadcast only up to ``BROADCAST_BYTES``; a larger
one is dealt into blocks of that size, each with a pass of its own.

Defined cases: null texts have no words and no hits; very long texts are matched whole; null item ids
count for no item; rows that are repeated (same id and text) are each returned; null ids are told
apart by their texts; empty tables give no hits; other columns are ignored.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.shared import materialize

BETWEEN_WORDS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BROADCAST_BYTES = 16 << 20


def lower_ascii(text: Column) -> Column:
    """A-Z to a-z, and nothing else."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, string.ascii_uppercase, string.ascii_lowercase))


def words_of(text: Column) -> Column:
    """Cut between words: one split is several times as fast as an extraction of each word."""
    return F.array_remove(F.split(lower_ascii(F.coalesce(text.cast("string"), F.lit(""))), BETWEEN_WORDS), "")


def benchmark_windows(items: DataFrame, window: int, id_col: str, text_col: str) -> DataFrame:
    """``words`` of each distinct window, ``items`` that hold it (ids as strings)."""
    cut = items.select(F.col(f"`{id_col}`").cast("string").alias("item"), words_of(F.col(f"`{text_col}`")).alias("all")).where(F.size("all") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("all") - (window - 1), F.lit(1)))
    return cut.select("item", F.explode(F.transform(starts, lambda i: F.slice("all", i, window))).alias("words")).groupBy("words").agg(F.collect_set("item").alias("items"))


def blocks_of(df: DataFrame, size: Column, key: str) -> list[DataFrame]:
    """The rows of a small table, for broadcasts of at most about BROADCAST_BYTES each."""
    total = df.agg(F.sum(size)).first()[0] or 0
    n = -(-total // BROADCAST_BYTES) or 1
    if n == 1:
        return [F.broadcast(df)]
    return [F.broadcast(df.where(F.pmod(F.xxhash64(key), F.lit(n)) == k)) for k in range(n)]


def union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def plan(docs_words: DataFrame, windows: DataFrame) -> DataFrame:
    """Each window that can occur: ``wanted`` (its words), ``items``, its rarest word ``term`` with its
    ``offset``, the next one, ``partner``, and ``delta``, how far behind ``term`` it stands."""
    placed = windows.select("words", "items", F.posexplode("words").alias("offset", "term"))
    vocabulary = materialize(placed.select("term").distinct(), "terms")
    seen = docs_words.select(F.explode_outer("words").alias("term"))
    counts = union([seen.join(v, "term") for v in blocks_of(vocabulary, F.octet_length("term") + 16, "term")]).groupBy("term").agg(F.count("*").alias("n"))
    ranked = F.array_sort(F.collect_list(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "offset", "term")))
    order = placed.join(materialize(counts, "counts"), "term", "left").groupBy("words").agg(F.first("items").alias("items"), ranked.alias("order"))
    pivot, partner = F.col("order")[0], F.coalesce(F.get("order", F.lit(1)), F.col("order")[0])
    columns = {"wanted": F.col("words"), "items": F.col("items"), "term": pivot["term"], "offset": pivot["offset"], "partner": partner["term"], "delta": partner["offset"] - pivot["offset"]}
    return materialize(order.where(pivot["n"] > 0).select(*[c.alias(n) for n, c in columns.items()]), "plan")


def postings(docs_words: DataFrame, terms: DataFrame, reach: int) -> DataFrame:
    """The index: id, text_key, term, pos; of a pivot also ``around``, the words up to ``reach`` words
    before and behind, ``lead`` of them before. The empty word, which no text has, stands at the end."""
    every = docs_words.select("id", "text_key", "words", F.posexplode(F.concat("words", F.array(F.lit("")))).alias("pos", "term"))
    ending = docs_words.sparkSession.range(1).select(F.lit("").alias("term"), F.lit(False).alias("pivot"))
    blocks = blocks_of(terms, F.octet_length("term") + 16, "term")
    blocks[0] = F.broadcast(blocks[0].unionByName(ending))
    lead = F.least("pos", F.lit(reach))
    around = F.when(F.col("pivot"), F.slice("words", F.col("pos") - lead + 1, lead + reach + 1))
    return materialize(union([every.join(b, "term") for b in blocks]).select("id", "text_key", "term", "pos", lead.alias("lead"), around.alias("around")), "postings")


def meetings(index: DataFrame, chosen: DataFrame, reach: int, slop: int | None) -> DataFrame:
    """The places where the lists of a pivot and a partner meet: id, text_key, term, partner, delta,
    pos, lead, around."""
    cell = 8 * reach
    pairs = materialize(chosen.select("term", "partner", "delta").distinct(), "pairs")
    heads = union([index.join(b, "term") for b in blocks_of(pairs, F.octet_length("term") + F.octet_length("partner") + 16, "term")])
    cells = F.array_distinct(F.array(*[F.floor((F.col("pos") + d) / cell) for d in (-reach, reach)]))
    heads = heads.select("id", "text_key", "term", "partner", "delta", "pos", "lead", "around", F.explode(cells).alias("cell"))
    tails = index.where("term <> ''").select(F.col("id").alias("of"), F.col("text_key").alias("key"), F.col("term").alias("name"), F.col("pos").alias("at"), F.floor(F.col("pos") / cell).alias("there"))
    meets = F.col("at") - F.col("pos") == F.col("delta")
    if slop is not None:
        meets = meets | (F.abs(F.col("at") - F.col("pos")) <= slop)
    same = heads["id"].eqNullSafe(tails["of"]) & (F.col("text_key") == F.col("key")) & (F.col("partner") == F.col("name")) & (F.col("cell") == F.col("there"))
    # both sides grow with the corpus, so neither is broadcast
    return heads.join(tails.hint("merge"), same & meets, "left_semi")


def matches(met: DataFrame, chosen: DataFrame, slop: int | None) -> DataFrame:
    """Phrase and proximity matches where lists meet."""
    begin = F.col("lead") - F.col("offset")
    phrase = (begin >= 0) & (F.slice("around", F.greatest(begin, F.lit(0)) + 1, F.size("wanted")) == F.col("wanted"))
    near = phrase
    if slop is not None:
        first = F.greatest(F.col("lead") - slop, F.lit(0))
        near = phrase | (F.size(F.array_except("wanted", F.slice("around", first + 1, F.col("lead") - first + slop + 1))) == 0)
    parts = []
    for block in blocks_of(chosen, F.octet_length(F.concat_ws(" ", "wanted", "items")) + 64, "wanted"):
        joined = met.join(block.withColumnsRenamed({"term": "t", "partner": "p", "delta": "d"}), (F.col("term") == F.col("t")) & (F.col("partner") == F.col("p")) & (F.col("delta") == F.col("d")) & near)
        span = F.struct((F.col("pos") - F.col("offset")).alias("begin"), F.size("wanted").alias("n"))
        parts.append(joined.select("id", "text_key", F.when(phrase, span).alias("span"), F.when(phrase, F.col("items")).alias("found"), F.col("items").alias("near")))
    return union(parts)


def decontaminate(docs: DataFrame, items: DataFrame, window: int = 10, slop: int | None = 20, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """For each row of ``docs``: id, ``text_key`` (a hash of the text), ``n_words``, ``n_hit``, ``n_items``, ``items_sha256``,
    ``contaminated``, ``spans`` (begin, n words) and ``n_near_items`` (items with phrase or proximity matches)."""
    text = F.col(f"`{text_col}`").cast("string")
    cut = docs.select(F.col(f"`{id_col}`").alias("id"), F.xxhash64(text).alias("text_key"), words_of(text).alias("words"))
    chosen = plan(cut.select("words"), benchmark_windows(items, window, item_col, item_text_col))
    listed = chosen.select("term", F.lit(True).alias("pivot")).union(chosen.select("partner", F.lit(False)))
    terms = materialize(listed.groupBy("term").agg(F.max("pivot").alias("pivot")), "listed")
    reach = max(window, slop or 0)
    index = postings(cut, terms, reach)
    hits = matches(meetings(index, chosen, reach, slop), chosen, slop)
    ends = index.where("term = ''").select("id", "text_key", F.col("pos").alias("ends"))
    found = ends.unionByName(hits, allowMissingColumns=True).groupBy("id", "text_key").agg(
        F.count("ends").cast("int").alias("rows"),
        F.max("ends").alias("n_words"),
        F.collect_set("span").alias("spans"),
        F.array_distinct(F.flatten(F.collect_set("found"))).alias("items"),
        F.array_distinct(F.flatten(F.collect_set("near"))).alias("near"),
    )
    covered = F.array_distinct(F.flatten(F.transform("spans", lambda s: F.sequence(s["begin"], s["begin"] + s["n"] - 1))))
    rows = found.select(F.col("id").alias(id_col), "text_key", F.col("n_words").cast("long").alias("n_words"), F.size(covered).cast("long").alias("n_hit"), F.size("items").cast("long").alias("n_items"), F.sha2(F.concat_ws(",", F.array_sort("items")), 256).alias("items_sha256"), "spans", F.size("near").cast("long").alias("n_near_items"), "rows")
    return rows.withColumn("contaminated", F.col("n_hit") > 0).select("*", F.explode_outer(F.array_repeat(F.lit(0), F.col("rows"))).alias("again")).drop("rows", "again")


def op8_decontamination(spark, sf_dir: str) -> DataFrame:
    """Words of ``documents`` inside 10-word windows of ``benchmark`` items, and how many items have
    all words of a window within 20 words of its rarest."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate(docs, items).select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated", "n_near_items")


_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
OP8_SQL = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT item_id, {_WORDS} AS w FROM benchmark WHERE text IS NOT NULL),
win AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[s:s + 9], ' ') AS t
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 8, 2))) AS s FROM b WHERE len(w) > 0)
),
sizes AS (SELECT DISTINCT n FROM win),
here AS (
  SELECT doc_id, s, n, array_to_string(w[s:s + n - 1], ' ') AS t
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM d, sizes WHERE len(w) >= n)
),
hit AS (SELECT doc_id, s, here.n, item_id FROM here JOIN win ON here.t = win.t AND here.n = win.n),
covered AS (SELECT doc_id, count(DISTINCT s + k) AS n_hit FROM hit, range(0, 10) r(k) WHERE k < n GROUP BY doc_id),
counts AS (SELECT x, count(*) AS seen FROM (SELECT unnest(w) AS x FROM d) GROUP BY x),
terms AS (SELECT t, unnest(string_split(t, ' ')) AS x, generate_subscripts(string_split(t, ' '), 1) AS o FROM (SELECT DISTINCT t FROM win)),
rarest AS (SELECT t, x FROM (SELECT t, x, seen, row_number() OVER (PARTITION BY t ORDER BY coalesce(seen, 0), o) AS r FROM terms LEFT JOIN counts USING (x)) WHERE r = 1 AND seen > 0),
posting AS (SELECT doc_id, unnest(w) AS x, generate_subscripts(w, 1) AS p FROM d),
beside AS (SELECT DISTINCT doc_id, t FROM posting JOIN rarest USING (x) JOIN d USING (doc_id) WHERE list_has_all(w[greatest(p - 20, 1):p + 20], string_split(t, ' '))),
near AS (SELECT doc_id, count(DISTINCT item_id) AS n_near FROM (SELECT doc_id, item_id FROM beside JOIN win USING (t) UNION ALL SELECT doc_id, item_id FROM hit) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS list FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS i FROM hit) GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(list, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated, coalesce(n_near, 0)::BIGINT AS n_near_items
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN items USING (doc_id) LEFT JOIN near USING (doc_id)
"""
