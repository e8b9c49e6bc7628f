"""A parallel corpus made from ``documents``: noise goes in by id, so that every operator has work.
The expressions are SQL that Spark and DuckDB read alike."""

from __future__ import annotations

from pyspark.sql import DataFrame

from corpusloom import lexicon as L
from corpusloom.sources.readers import spread

_ARABIC = f"translate(lower(text), '{L.ARABIZI_LATIN}', '{L.ARABIZI_ARABIC}')"
COLUMNS = {
    "row_index": "doc_id + 1",
    "data_id": "'data' || cast(doc_id as string)",
    "id": "'DOC_' || cast(doc_id as string)",
    "classe": "CASE doc_id % 4 WHEN 0 THEN 'A' WHEN 1 THEN 'B' WHEN 2 THEN 'C' ELSE NULL END",
    "darija_arabic": f"CASE WHEN doc_id % 19 = 0 THEN {_ARABIC} || ' ديال بززاف ـڭ كلمة غير مفهومة' WHEN doc_id % 31 = 0 THEN 'latin ' || {_ARABIC} ELSE {_ARABIC} END",
    "darija_arabizi": "CASE WHEN doc_id % 5 = 0 THEN lower(text) || ' b7al 3ada hhhhello 2025 ism qadim ok' WHEN doc_id % 37 = 0 THEN 'هاد ' || text ELSE lower(text) END",
    "english": "CASE WHEN doc_id % 97 = 0 THEN ' <unk> ' WHEN doc_id % 89 = 0 THEN 'we corrected the english mt artifact in this row' "
    "WHEN doc_id % 7 = 0 THEN text || ' <unk> @-@ [UNK] end , now' WHEN doc_id % 11 = 0 THEN '<b>' || text || '</b> [name](http://x.example/a) **bold** __it__ `code` @bob hi' "
    "WHEN doc_id % 13 = 0 THEN text || ' 😀 don''t visit https://a.example/x?y=1 or WWW.B.EXAMPLE/z the the end end end' WHEN doc_id % 17 = 0 THEN '# ' || text || '  wide  kalima ghair mafhuma space' ELSE text END",
    "modern_standard_arabic": f"CASE WHEN doc_id % 23 = 0 THEN {_ARABIC} || ' ديال' ELSE {_ARABIC} || ' إلى الكتاب' END",
    "english_word_count": "CASE WHEN doc_id % 2 = 0 THEN cast(doc_id % 300 as string) ELSE 'x' END",
    "status": "CASE WHEN doc_id % 29 = 0 THEN 'error' WHEN doc_id % 3 = 0 THEN 'GENERATED' WHEN doc_id % 41 = 0 THEN NULL ELSE 'PARTIALLY_VALIDATED' END",
}
SQL = "corpus AS (SELECT doc_id, lang, " + ", ".join(f"{e} AS {n}" for n, e in COLUMNS.items()) + " FROM documents)"


def table(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def corpus(spark, sf_dir: str) -> DataFrame:
    return spread(table(spark, sf_dir, "documents")).selectExpr("doc_id", "lang", *[f"{e} AS {n}" for n, e in COLUMNS.items()])
