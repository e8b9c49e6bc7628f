"""Operators on small tables: accounting, precedence, merges, null keys, answers of a model."""

import json

import pytest
from pyspark.sql import functions as F

from corpusloom.operators import cleaning, corrections, flags, merging, profile, similarity
from corpusloom.sources import readers, sinks


def test_cleaning_accounts_for_every_row(spark):
    df = readers.demo_corpus(spark).withColumns({"status": F.when(F.col("row_index") == 2, "error"), "english_word_count": F.lit("4")})
    done = cleaning.clean_corpus(df).persist()
    reasons = {r["row_index"]: r["drop_reason"] for r in done.collect()}
    assert reasons == {1: None, 2: "status", 3: "empty"}
    counts = cleaning.stage_counts(done).first()
    assert counts["input_rows"] == 3 == counts["output_rows"] + counts["dropped_status"] + counts["dropped_empty"]
    row = cleaning.kept(done).first()
    assert row["english"] == "short row see" and row["english_word_count"] == 3 and row["darija_arabizi"] == "hada mital"


def test_top_words_break_ties_by_first_place(spark):
    df = spark.createDataFrame([(1, "b a"), (2, "a b c")], "i int, t string")
    assert [tuple(r) for r in cleaning.top_words(df, "t", "i").collect()] == [("b", 2), ("a", 2), ("c", 1)]


def test_missing_columns_raise(spark):
    with pytest.raises(ValueError):
        cleaning.clean_corpus(spark.range(1))


def test_skip_reasons_in_order(spark):
    df = spark.createDataFrame([(i, f"k{i}", s) for i, s in enumerate(["A", "A", "B", "A", "A", "A"], 1)], "row_index long, k string, status string")
    seen = spark.createDataFrame([("k2",), ("k2",)], "k string")
    got = {r["row_index"]: r["skip_reason"] for r in merging.skip_reasons(df, seen, "k", 2, 5, "a", 1).collect()}
    assert got == {1: "before_start", 2: "checkpoint", 3: "status", 4: None, 5: "max_rows", 6: "after_end"}


def test_halves_last_row_wins(spark):
    base = spark.createDataFrame([(1, "a", "0"), (2, "b", "0"), (3, "c", "0"), (4, "d", "0")], "row_index int, k string, v string")
    first = spark.createDataFrame([(1, "a", "1"), (2, "a", "2")], "row_index int, k string, v string")
    last = spark.createDataFrame([(1, "c", "9")], "row_index int, k string, v string")
    got = merging.merge_halves(base, first, last, "k", 2, ["v"]).orderBy("row_index").collect()
    assert [(r["v"], r["merge_source"]) for r in got] == [("2", "first"), ("0", "fallback"), ("9", "last"), ("0", "fallback")]
    assert merging.merge_halves(base, first, last, "k", 2, ["v"], first_fallback=False).count() == 3


def test_null_keys_match(spark):
    df = spark.createDataFrame([(1, None, "x"), (2, None, "y"), (3, "k", "z")], "i int, k string, v string")
    assert {(r["source_v"], r["cleaned_v"]) for r in profile.compare(df, df, "k", "i").collect()} == {("x", "x"), ("z", "z")}


def test_zero_vectors_and_strict_thresholds(spark):
    df = spark.createDataFrame([([0.0, 0.0], [1.0, 0.0], 0.8), ([1.0, 1.0], [1.0, 0.0], 0.5)], "a array<double>, b array<double>, s double")
    rows = df.select(similarity.cosine(F.col("a"), F.col("b")).alias("c"), *[v.alias(k) for k, v in similarity.classify(F.col("s")).items()]).collect()
    assert rows[0]["c"] == 0.0 and abs(rows[1]["c"] - 0.5**0.5) < 1e-12
    assert not rows[0]["suspicious"] and rows[1]["suspicious"] and not rows[1]["low_similarity"]
    with pytest.raises(ValueError):
        similarity.classify(F.lit(1.0), 0.5, 0.6)


def test_provider_retries_then_reports(spark):
    df = corrections.requests(readers.demo_corpus(spark).coalesce(1), "row_index")

    def provider(prompts, settings):
        if any("ROW" in p for _, p in prompts):
            raise TimeoutError
        if any("LICENSE" in p for _, p in prompts):
            raise KeyError
        return [json.dumps({"english": {"corrected": settings.model, "issues": "x"}}) for _ in prompts]

    df = df.union(df.limit(1).selectExpr("9", "system", "'LICENSE'"))
    limits = corrections.Limits(requests_a_minute=1e6, tokens_a_minute=1e9, retries=1, base_seconds=0.01)
    got = {r["row_index"]: (r["response"], r["error"]) for r in corrections.ask(df, provider, "row_index", corrections.CallSettings(model="m1"), limits, rows_a_call=1).collect()}
    assert got[2] == (None, "TimeoutError") and got[9] == (None, "KeyError") and "m1" in got[1][0]


def test_failures_that_do_not_pass_are_not_tried_again():
    tries, waited = [], []

    def provider(prompts, settings):
        tries.append(len(prompts))
        raise KeyError if len(tries) > 1 else TimeoutError

    bucket = corrections.TokenBucket(60, 6000, clock=lambda: sum(waited), sleep=waited.append)
    limits = corrections.Limits(retries=5, base_seconds=2.0)
    assert corrections.call(provider, [("s", "p")], corrections.CallSettings(), limits, bucket) == ([None], "KeyError")
    assert len(tries) == 2 and 2.0 <= waited[0] <= 2.5


def test_bucket_holds_requests_and_tokens_to_their_rates():
    waited = []
    bucket = corrections.TokenBucket(60, 600, clock=lambda: sum(waited), sleep=waited.append)
    for _ in range(5):
        bucket.take(200)
    assert 39.9 < sum(waited) < 40.1  # 1,000 tokens, of which 600 at once and 10 a second after
    bucket.take(10_000)  # more than a minute's: as much as the bucket holds


def test_prompts_and_fences(spark):
    df = readers.demo_corpus(spark)
    strict = json.loads(corrections.strict_requests(df, "row_index").where("row_index = 1").first()["prompt"])
    assert strict["input"]["english"] == "This is a short row. See https://a.example"
    asked = json.loads(corrections.consistency_requests(df, "row_index").first()["prompt"])
    assert set(asked) == {"input", "output_schema"} and asked["output_schema"]["consistent"] == "bool"
    answers = ["```json\n{\"english\": {\"corrected\": \"x\", \"issues\": [\"a\"]}}\n```", "[1]", "", None]
    rows = corrections.parse_answer(spark.createDataFrame([(a,) for a in answers], "response string")).collect()
    assert [r["parsed"] for r in rows] == [True, False, False, False] and rows[0]["answer_english"] == "x" and rows[0]["issues_english"] == ["a"]


def test_blank_answers_count_only_on_request(spark):
    df = readers.demo_corpus(spark).withColumns({f"answer_{c}": F.lit("") for c in ("darija_arabic", "darija_arabizi", "english", "modern_standard_arabic")}).where("row_index = 2")
    assert corrections.adopt(df).first()["changed_fields"] == ""
    assert corrections.adopt(df, blank_counts=True).first()["english"] == ""


def test_zip_by_key(spark):
    rows = spark.createDataFrame([(i, f"d{i}") for i in range(1, 13)], "row_index int, data_id string")
    answers = spark.createDataFrame([(0, '[{"data_id": "d2", "english": "b"}, {"data_id": "d1", "english": "a"}]'), (1, "none")], "batch long, response string")
    assert sorted((r["data_id"], r["answer"]["english"]) for r in corrections.zip_batches(rows, answers, by_key="data_id").collect()) == [("d1", "a"), ("d2", "b")]


def test_embeddings_of_a_provider(spark):
    df = readers.demo_corpus(spark).withColumn("english", F.when(F.col("row_index") < 3, F.col("english")).otherwise(""))
    rows = {r["row_index"]: r for r in similarity.embed(df, lambda texts: [[float(len(t)), float(t == "[empty]")] for t in texts], "row_index").collect()}
    assert rows[3]["vector_english"] == [7.0, 1.0] and rows[1]["vector_english"][1] == 0.0


def test_plans_compute_no_text_twice(spark):
    from corpusloom.plans import queries

    for name in ("top_words", "clean_corpus", "top_words_darija", "clean_stage_counts"):
        plan = queries.QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("ArrowEvalPython") == 1, name


def test_null_groups_and_repeated_keys(spark):
    df = spark.createDataFrame([(None, 1), (None, 9), ("a", 5), ("a", None)], "k string, n int")
    assert {tuple(r) for r in profile.histogram(df, "n", 2, "k").collect()} == {(None, 0, 1), (None, 1, 1), ("a", 0, 1)}
    assert {(r["k"], r["whisker_low"], r["whisker_high"]) for r in profile.boxplot(df, "n", "k").collect()} == {(None, 1, 9), ("a", 5, 5)}
    base = spark.createDataFrame([(1, "x"), (2, "y"), (None, "z")], "k int, v string")
    changes = spark.createDataFrame([(1, "old", 1), (1, "new", 2), (None, "no", 1)], "k int, v string, t int")
    assert {tuple(r) for r in merging.upsert(base, changes, "k", ["v"], "t").collect()} == {(1, "new", True), (2, "y", False), (None, "z", False)}


def test_encodings(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes("id,t\n1,caf\u00e9 \ufffd\n".encode())
    (tmp_path / "b.csv").write_bytes("id,t\n1,caf\u00e9\n".encode("latin-1"))
    assert readers.read_csv_any(spark, f"file://{tmp_path}/a.csv").first()["t"] == "café \ufffd"
    assert readers.read_csv_any(spark, f"file://{tmp_path}/b.csv").first()["t"] == "café"
    long = "x" * 300_000
    (tmp_path / "c.csv").write_text(f"id,t\n1,{long}\n")
    assert readers.read_csv(spark, f"file://{tmp_path}/c.csv").first()["t"] == long


def test_files_of_the_driver(spark, tmp_path, monkeypatch):
    (tmp_path / ".env").write_text("# c\nA=1\nB='two'\nnothing\n")
    monkeypatch.setenv("A", "mine")
    assert readers.read_env(str(tmp_path / ".env")) == {"A": "mine", "B": "two"} and readers.read_env(str(tmp_path / "no")) == {}
    (tmp_path / "x.csv").write_text("a")
    assert readers.discover(str(tmp_path), ["x.csv", "y.csv"]) == [str(tmp_path / "x.csv")]
    assert [r["exists"] for r in readers.availability(spark, {"x": str(tmp_path / "x.csv"), "y": "/no"}).collect()] == [True, False]
    assert readers.read_report(spark, f"file://{tmp_path}/none.json") is None
    assert sinks.derived_paths("/a/b.csv")["report.json"] == "/a/b.report.json" and len(sinks.derived_paths("b.csv", "all4")) == 3
    assert not sinks.snapshot_when_due(spark.range(3), f"file://{tmp_path}/s", 49)
    assert sinks.snapshot_when_due(spark.range(3), f"file://{tmp_path}/s", 50) and spark.read.parquet(f"file://{tmp_path}/s").count() == 3
    assert sinks.columns_with_extras(["a", "b"], ["b", "c"]) == ["a", "b", "c"]


def test_previews(spark):
    before = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    after = spark.createDataFrame([(1, "a"), (2, "c")], "k int, v string")
    assert sinks.differences(before, after, "k", ["v"]) == "@ 2\n- v: b\n+ v: c"
    assert sinks.preview(before, 1) == "row 1\n  k: 1\n  v: a"


def test_options_of_cleaning():
    assert cleaning.listed(" The, a ,,OF") == ("the", "a", "of")
    with pytest.warns(UserWarning):
        cleaning.CleaningOptions(english_normalization="lemma")
    with pytest.raises(ValueError):
        cleaning.CleaningOptions(english_normalization="other")


def test_missing_can_be_flagged(spark):
    df = readers.demo_corpus(spark).withColumn("english", F.lit(""))
    assert {r["row_status"] for r in flags.flag_rows(df, coherence=False, missing="flag").collect()} == {"FLAGGED"}
    assert {r["row_status"] for r in flags.flag_rows(df, coherence=False).collect()} == {"REMOVED"}


def test_flags(spark):
    df = readers.demo_corpus(spark)
    rows = {r["row_index"]: r for r in flags.flag_rows(df).collect()}
    assert rows[1]["row_status"] == "FLAGGED" and "darija_arabic_contains_latin" in rows[1]["issues"]


def test_csv_round_trip_and_na(spark, tmp_path):
    df = spark.createDataFrame([(1, 'a "q"\nb', "null", "")], "row_index int, x string, y string, z string")
    sinks.write_csv(df, f"file://{tmp_path}/c", ["x", "y", "z"], "row_index", single=True)
    back = readers.read_csv(spark, f"file://{tmp_path}/c").first()
    assert (back["x"], back["y"], back["z"]) == ('a "q"\nb', "null", "")
    back = readers.read_csv_na(spark, f"file://{tmp_path}/c").first()
    assert back["y"] is None and back["z"] is None


def test_jsonl_last_wins(spark, tmp_path):
    (tmp_path / "c.jsonl").write_text('{"k": "a", "v": 1}\nbroken\n\n{"k": "a", "v": 2}\n')
    assert [tuple(r) for r in readers.read_jsonl(spark, f"file://{tmp_path}/c.jsonl", "k string, v int", "k").collect()] == [("a", 2)]


def test_row_index_is_gapless(spark):
    df = readers.with_row_index(spark.range(100).repartition(7), ["id"])
    assert [r["row_index"] for r in df.orderBy("id").collect()] == list(range(1, 101))


def test_reports(spark):
    df = spark.createDataFrame([(1, "d1", "A", "VALIDATED", "english", "", "1"), (2, "d2", None, "ERROR", "", "ERROR:X", "2")], "row_index int, data_id string, classe string, status string, changed_fields string, qc_notes string, shard string")
    df = df.withColumns({c: F.lit("text") for c in ("darija_arabic", "darija_arabizi", "english", "modern_standard_arabic")})
    assert "- errors: 1" in sinks.shard_report(df, "1") and "| all | 2 | 1 | 1 |" in sinks.global_report(df) and "Anomalies" in sinks.shard_report(df, "1") and "| UNKNOWN | 1 | 0 | 1 |" in sinks.global_report(df)


def test_stream_cleans_each_row_once(spark, tmp_path):
    from corpusloom.streaming.incremental import clean_arrivals

    df = readers.demo_corpus(spark).withColumn("data_id", F.col("row_index").cast("string"))
    for _ in range(2):
        df.write.mode("append").parquet(f"file://{tmp_path}/in")
        clean_arrivals(spark, f"file://{tmp_path}/in", df.schema, f"file://{tmp_path}/out", f"file://{tmp_path}/progress").awaitTermination()
    assert spark.read.parquet(f"file://{tmp_path}/out").count() == 3
