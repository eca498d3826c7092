"""HTML, records, masking, storage, streaming."""

import json

import hashlib

import pytest
from pyspark.sql import functions as F

from kedge.operators.compare import record_diff
from kedge.sources import html, masking, records, store
from kedge.streaming import ingest

PAGE = """<html><head><link rel=canonical href="/x"><title>T</title></head><body data-mode="marathon"><h1>Раздел</h1>
<span data-name="question-number"> 3/40 </span><i data-name="questions-passed">2</i><i data-name="questions-remain">38</i>
<div data-name="current-question-content"><h4>Кто   уступает?</h4><img src="/m/a.png"></div>
<form id="step-form" action="/next" data-valid-answers="id1, id2" data-multiple-answers="1"><input type=hidden name=_token value="s&amp;e">
<input type=radio name="answer[]" id=a1 value=id1><label for=a1><b class="answers-label">Левый</b></label><input type=radio name="answer[]" id=a2 value=id2><label for=a2>Правый</label></form>
<div class="doc-item big"><p class="doc-item__title">1.2. Огни</p><a href="/uploads/document/2025-01-02/f.PDF?x=1">Скачать</a></div>
<a href="/uploads/document/list.docx">Список</a><a href="/uploads/document/g.pdf">Без темы</a><a href="2.1 h.pdf">2.1 Маяки</a><a href="/about">О нас</a><p>unclosed"""


@pytest.fixture(scope="module")
def els(spark):
    df = spark.createDataFrame([("p", PAGE.encode()), ("empty", b""), ("null", None), ("bad", b"<p>\xff<b>x")], "id string, body binary")
    return html.elements(df, id="id", html="body").cache()


def test_elements(els):
    assert {r.id for r in els.collect()} == {"p", "bad"}
    bad = {r.tag: r for r in els.where("id = 'bad'").collect()}
    assert bad["p"].last == 1 and bad["p"].text == "\ufffdx"


def test_forms_media_and_question(spark, els):
    f = html.forms(els, id="id").collect()[0]
    assert (f.action, f.fields) == ("/next", {"_token": "s&e"})
    assert [r.url for r in html.media(els, F.lit("https://h.example/q/"), id="id").collect()] == ["https://h.example/m/a.png"]
    q = html.question_page(els, id="id").where("id = 'p'").collect()[0]
    assert (q.position, q.total, q.passed, q.remain, q.multiple, q.correct_answer_ids) == (3, 40, 2, 38, True, ["id1", "id2"])
    assert [(a.id, a.text) for a in q.answers] == [("id1", "Левый"), ("id2", "Правый")]
    with pytest.raises(Exception, match="missing position"):
        html.required(html.question_page(els, id="id"), "position", "position").collect()


def test_links(els):
    got = {r.href: r for r in html.document_links(els, id="id", base=F.lit("https://h.example/docs/")).collect()}
    assert set(got) == {"/uploads/document/2025-01-02/f.PDF?x=1", "/uploads/document/list.docx", "/uploads/document/g.pdf", "2.1 h.pdf"}
    f = got["/uploads/document/2025-01-02/f.PDF?x=1"]
    assert (f.topic_code, f.topic_title, f.reason) == ("1.2", "Огни", None)
    assert got["/uploads/document/list.docx"].reason == "non_pdf" and got["/uploads/document/g.pdf"].reason == "no_explicit_topic"
    assert got["2.1 h.pdf"].topic_code == "2.1" and got["2.1 h.pdf"].target == "https://h.example/docs/2.1 h.pdf"


def test_masking(spark):
    rows = [(b'{"session_token":{"v":"a\\"b"},"q":"a\\"b and x"}', False), (b'<input name=csrf value="k&amp;y"> k&amp;y k%26y', True), (b"{broken known", False), (None, True)]
    df = spark.createDataFrame(rows, "body binary, page boolean")
    got = [None if r.body is None else bytes(r.body).decode() for r in masking.mask_secrets(df, body="body", is_html=F.col("page"), known=("known",)).collect()]
    assert got[0] == '{"session_token":{"v":"REDACTED_SECRET"},"q":"REDACTED_SECRET and x"}'
    assert got[1] == '<input name=csrf value="REDACTED_SECRET"> REDACTED_SECRET REDACTED_SECRET'
    assert got[2] == "{broken REDACTED_SECRET" and got[3] is None
    t = spark.createDataFrame([(1, "C:\\Users\\x"), (2, "ok"), (3, None)], "id int, t string")
    assert [r.id for r in masking.leaks(t, id="id", text="t", pattern=r"[A-Z]:\\").collect()] == [1]


ITEM = {"id": "s", "current_question": {"id": "q", "content": "Кто?", "resources_path": ["u/1"], "type": "single", "is_additional": None, "new": 1}, "current_answers": [{"id": "0cc7b5a0-1f6e-4b8f-9a50-aaaaaaaaaaaa", "title": "А", "resources_path": []}, {"id": "0cc7b5a0-1f6e-4b8f-9a50-bbbbbbbbbbbb", "title": "Б", "resources_path": None}], "questions_count": 9, "question_number": 2, "questions_passed": 1}


def test_items(spark):
    one = "0cc7b5a0-1f6e-4b8f-9a50-aaaaaaaaaaaa"
    raws = [json.dumps({**ITEM, "valid_answers": v}) for v in (f" {one} ", [one], "", "x")] + [None]
    got = [r.q for r in spark.createDataFrame([(r,) for r in raws], "raw string").select(records.items(F.col("raw")).alias("q")).collect()]
    assert [g.correct_answer_ids for g in got] == [[one], [one], None, None, None]
    assert got[0].answers[0].correct is True and got[0].answers[1].correct is False and got[0].resources[0].url == "u/1" and got[0].total == 9


def test_json_sources(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"a":1,"b":"x"}\n{"a":2,"zz":3}\n')
    assert [r.a for r in records.json_lines(spark, str(tmp_path / "a.jsonl"), "a int, b string").collect()] == [1, 2]
    from pyspark.sql import types as T

    assert [r["keys"] for r in records.unknown_keys(spark, str(tmp_path / "a.jsonl"), T._parse_datatype_string("a int, b string")).collect()] == [["zz"]]
    (tmp_path / "bad.jsonl").write_text('{"a":1}\n{broken\n')
    with pytest.raises(Exception):
        records.json_lines(spark, str(tmp_path / "bad.jsonl"), "a int").collect()
    (tmp_path / "m.json").write_text('{"urls": {"u": {"sha256": "s", "bytes": 3}}}')
    assert [tuple(r) for r in records.json_map(spark, str(tmp_path / "m.json"), "struct<sha256:string,bytes:bigint>", field="urls").collect()] == [("u", "s", 3)]
    assert records.table_or_empty(spark, str(tmp_path / "none"), "a int").count() == 0
    assert records.json_object(spark, str(tmp_path / "m.json")).count() == 1


def test_objects_and_versions(spark, tmp_path):
    root = str(tmp_path / "objects")
    df = spark.createDataFrame([(b"one",), (b"two",), (b"one",), (None,)], "content binary")
    store.put_objects(df, root)
    store.put_objects(df, root)
    assert spark.read.parquet(root).count() == 2 and store.damaged_objects(spark, root).count() == 0
    v = spark.createDataFrame([("u", "a", 1, 5), ("u", "b", 2, 6), ("w", "A", 1, 5), (None, "z", 1, 1)], "url string, sha256 string, checked_at int, bytes int")
    assert sorted((r.url, r.sha256) for r in store.latest_versions(v).collect()) == [("u", "b"), ("w", "A")]
    assert tuple(store.distinct_bytes(v).collect()[0]) == (3, 12)


def test_publish_and_corruption(spark, tmp_path):
    stage = tmp_path / "stage"
    store.build_snapshot(spark, stage, {"questions": spark.range(5).coalesce(1)}, facts={"previous_snapshot": None})
    assert store.current_pointer(tmp_path) is None
    store.promote(spark, tmp_path, stage, "s1")
    assert store.current_pointer(tmp_path)["snapshot_id"] == "s1" and not stage.exists()
    store.build_snapshot(spark, stage, {"questions": spark.range(6).coalesce(1)}, facts={"previous_snapshot": "s1"})
    part = next((stage / "questions").glob("*.parquet"))
    part.write_bytes(part.read_bytes() + b"x")
    part.with_name(f".{part.name}.crc").unlink()  # else the file system notices before the manifest does
    assert [r.problem for r in store.manifest_differences(spark, stage).collect()] == ["changed"]
    with pytest.raises(store.PipelineError):
        store.promote(spark, tmp_path, stage, "s2")
    assert store.current_pointer(tmp_path)["snapshot_id"] == "s1" and stage.exists()
    (tmp_path / "snapshots/s1/manifest.json").write_text("{}")
    with pytest.raises(store.PipelineError):
        store.current_pointer(tmp_path)
    for bad in ("..", "a/b", ""):
        with pytest.raises(store.PipelineError):
            store.snapshot_path(tmp_path, bad)
    with pytest.raises(store.PipelineError):
        store.safe_output(tmp_path / "media" / "x", tmp_path)


def test_lock_and_retries(tmp_path):
    with store.WriterLock(tmp_path / "lock"):
        with pytest.raises(store.PipelineError):
            store.WriterLock(tmp_path / "lock").__enter__()
    assert not (tmp_path / "lock").exists()
    waits, calls = [], []

    def step(kind, times):
        calls.append(kind)
        if len(calls) <= times:
            raise store.PipelineError(kind, "x")
        return "done"

    assert store.with_retries(lambda: step("transient", 2), sleep=waits.append, failures=tmp_path / "failed") == "done"
    assert waits == [30.0, 60.0] and len(list((tmp_path / "failed").iterdir())) == 2
    calls.clear()
    with pytest.raises(store.PipelineError):
        store.with_retries(lambda: step("protocol", 1), sleep=waits.append)
    assert len(calls) == 1


def test_queues_and_lines(spark, tmp_path):
    df = spark.createDataFrame([("a", "exact"), ("b", "ambiguous"), ("c", None)], "k string, tier string")
    store.write_queues(df, str(tmp_path / "q"), {"review": "tier = 'ambiguous'", "unmatched": "tier is null"})
    assert [r.k for r in spark.read.parquet(str(tmp_path / "q/review")).collect()] == ["b"]
    store.write_lines(df, str(tmp_path / "l"), order=["k"])
    assert '{"k":"c","tier":null}' in "".join(p.read_text() for p in (tmp_path / "l").glob("part-*"))


def test_streaming_ingest(spark, tmp_path):
    src, out = tmp_path / "src", tmp_path / "out"
    for i in range(3):
        spark.createDataFrame([(i, 3), (i + 10, 3)], "position int, total int").coalesce(1).write.mode("append").parquet(str(src))
    stream = ingest.file_stream(spark, str(src), "position int, total int")
    sink = ingest.checked(ingest.append_once(str(out)), ingest.drifting_totals("total"), "drifting total")
    ingest.run_to_end(stream, sink, checkpoint=str(tmp_path / "cp"))
    assert spark.read.parquet(str(out)).count() == 6
    ingest.run_to_end(stream, sink, checkpoint=str(tmp_path / "cp"))
    assert spark.read.parquet(str(out)).count() == 6
    spark.createDataFrame([(99, 3), (98, 4)], "position int, total int").coalesce(1).write.mode("append").parquet(str(src))
    with pytest.raises(Exception, match="drifting total"):
        ingest.run_to_end(stream, sink, checkpoint=str(tmp_path / "cp"))
    assert spark.read.parquet(str(out)).count() == 6


def test_total_is_steady_over_batches(spark, tmp_path):
    src, out = tmp_path / "src", tmp_path / "out"
    src.mkdir()
    stream = ingest.file_stream(spark, str(src), "position int, total int")
    sink = ingest.checked(ingest.append_once(str(out)), ingest.steady_total("total", str(tmp_path / "total.json")), "another total")
    for i, total in enumerate((3, 3, 4)):
        spark.createDataFrame([(i, total)], "position int, total int").coalesce(1).write.mode("append").parquet(str(src))
        if total == 3:
            ingest.run_to_end(stream, sink, checkpoint=str(tmp_path / "cp"))
    with pytest.raises(Exception, match="another total"):
        ingest.run_to_end(stream, sink, checkpoint=str(tmp_path / "cp"))
    assert spark.read.parquet(str(out)).count() == 2


def test_stored_objects_are_hashed_again(spark, tmp_path):
    root = str(tmp_path / "objects")
    store.put_objects(spark.createDataFrame([(b"a",), (b"b",), (None,)], "content binary"), root)
    store.put_objects(spark.createDataFrame([(b"a",), (b"c",)], "content binary"), root)
    assert spark.read.parquet(root).count() == 3
    spark.createDataFrame([("f" * 64, b"zz", 2)], store.OBJECTS).write.mode("append").parquet(root)
    assert store.damaged_objects(spark, root).count() == 1
    bad = spark.read.parquet(root).where("sha256 = 'x'").unionByName(spark.createDataFrame([(hashlib.sha256(b"d").hexdigest(), b"not d", 5)], store.OBJECTS))
    bad.write.mode("append").parquet(root)
    with pytest.raises(store.PipelineError, match="damaged"):
        store.put_objects(spark.createDataFrame([(b"d",)], "content binary"), root)


def test_items_that_cannot_be_taken(spark):
    good = '{"current_question":{"id":"q","content":"x","resources_path":[],"type":"single","is_additional":false},"current_answers":[{"id":"0cc7b5a0-1f6e-4b8f-9a50-aaaaaaaaaaaa","title":"t","resources_path":[]}],"questions_count":2,"question_number":1,"questions_passed":0,"valid_answers":"0cc7b5a0-1f6e-4b8f-9a50-aaaaaaaaaaaa"}'
    raws = [good, "{", good.replace('"content":"x",', ""), good.replace('"resources_path":[],"type"', '"resources_path":"u","type"'), good.replace('"valid_answers":"0cc', '"valid_answers":"zz'), '{"current_question":null}', None]
    taken, rest = records.checked_items(spark.createDataFrame([(r,) for r in raws], "raw string"), raw="raw")
    assert [r.item.text for r in taken.collect()] == ["x"]
    assert sorted(r.problem for r in rest.collect()) == ["ended", "malformed", "malformed", "missing", "resources", "valid_answers"]


def test_windowed_stream(spark, tmp_path):
    spark.sql("select timestamp'2025-01-01 00:00:10' as ts, 'a' as k union all select timestamp'2025-01-01 00:01:10', 'a'").write.parquet(str(tmp_path / "s"))
    df = ingest.file_stream(spark, str(tmp_path / "s"), "ts timestamp, k string")
    counted = ingest.windowed_counts(df, time="ts", window="1 minute", late="5 minutes", by=["k"])
    q = counted.writeStream.format("memory").queryName("counted").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination()
    assert spark.table("counted").agg(F.sum("n")).collect()[0][0] == 2


def test_stream_of_snapshots_is_the_batch_diff(spark, tmp_path):
    a = spark.createDataFrame([("x", 1), ("y", 1)], "k string, v int")
    b = spark.createDataFrame([("x", 2), ("z", 1)], "k string, v int")
    for df in (a, b):
        df.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    states = []
    ingest.run_to_end(ingest.file_stream(spark, str(tmp_path / "in"), "k string, v int"), lambda df, n: states.append([tuple(r) for r in df.collect()]), checkpoint=str(tmp_path / "cp"))
    assert sorted(map(sorted, states)) == sorted([sorted([("x", 1), ("y", 1)]), sorted([("x", 2), ("z", 1)])])
    assert {r.status for r in record_diff(a, b, key="k", fields=["v"]).collect()} == {"changed", "removed", "added"}
