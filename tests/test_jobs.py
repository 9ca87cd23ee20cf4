import json

import pytest

from sparkretrieve.operators.embedding import HashingEncoder
from sparkretrieve.plans import jobs
from sparkretrieve.sources import records


def _docs(spark):
    return spark.createDataFrame(
        [("wikipedia_1", "wikipedia", "1", "One", "10", "", "alpha beta gamma " * 30, {"page_id": "1"}),
         ("wikipedia_2", "wikipedia", "2", "Two", "11", "", "   ", {"page_id": "2"})],
        records.DOCUMENT_SCHEMA)


def test_chunk_and_embed_jobs(spark, tmp_path):
    out, man = str(tmp_path / "chunks"), str(tmp_path / "manifests" / "chunks")
    summary = jobs.chunk_documents_job(_docs(spark), out, man, chunk_size=200, chunk_overlap=20)
    assert summary.documents_processed == 2 and summary.chunks_saved >= 2
    chunks = records.read_chunks(spark, out, fmt="parquet")
    assert chunks.count() == summary.chunks_saved
    assert spark.read.json(man).count() == summary.chunks_saved
    n = jobs.embed_chunks_job(chunks, HashingEncoder(16), str(tmp_path / "emb"), str(tmp_path / "manifests" / "emb"))
    assert n == summary.chunks_saved
    vecs = records.read_vector_records(spark, str(tmp_path / "emb"), fmt="parquet")
    assert vecs.count() == n
    # Re-running the chunk job overwrites instead of duplicating records.
    jobs.chunk_documents_job(_docs(spark), out, man, chunk_size=200, chunk_overlap=20)
    assert records.read_chunks(spark, out, fmt="parquet").count() == summary.chunks_saved


def test_json_record_layout(spark, tmp_path):
    d = tmp_path / "docs"
    d.mkdir()
    for i in (2, 1):
        (d / f"wikipedia_{i}.json").write_text(json.dumps({
            "document_id": f"wikipedia_{i}", "source": "wikipedia", "source_id": str(i), "title": "T",
            "version": "1", "updated_at": "", "text": "x", "metadata": {"page_id": str(i)}}, indent=2))
    docs = records.read_documents(spark, str(d), limit=1, validate=True).collect()
    assert [r.document_id for r in docs] == ["wikipedia_1"]
    (d / "bad.json").write_text(json.dumps({"document_id": "x"}))
    with pytest.raises(KeyError):
        records.read_documents(spark, str(d), validate=True)
    with pytest.raises(FileNotFoundError, match="Embedding directory not found"):
        records.read_vector_records(spark, str(tmp_path / "missing"))


def test_one_per_id_keeps_latest(spark):
    df = spark.createDataFrame([("a", "1", "old"), ("a", "2", "new"), ("b", "1", "x")], "id string, v string, t string")
    rows = sorted((r.id, r.t) for r in jobs.one_per_id(df, "id", "v").collect())
    assert rows == [("a", "new"), ("b", "x")]


def test_ingest_job(spark, tmp_path):
    import bz2
    body = ("<mediawiki>" + "".join(
        f"<page><title>T{i}</title><id>{i}</id><revision><id>{i}0</id><text>t{i}</text></revision></page>"
        for i in range(5)) + "</mediawiki>")
    p = tmp_path / "d.xml.bz2"
    p.write_bytes(bz2.compress(body.encode()))
    n = jobs.ingest_dump(spark, str(p), str(tmp_path / "docs"), str(tmp_path / "man"), limit=3)
    assert n == 3
    assert spark.read.json(str(tmp_path / "man")).count() == 3


def _dump(tmp_path, name, pages):
    body = "<mediawiki>" + "".join(
        f"<page><title>T{i}</title><id>{i}</id><revision><id>{rev}</id><text>{text}</text></revision></page>"
        for i, rev, text in pages) + "</mediawiki>"
    p = tmp_path / name
    p.write_text(body)
    return str(p)


def test_second_dump_keeps_what_it_does_not_hold(spark, tmp_path):
    out, man = str(tmp_path / "docs"), str(tmp_path / "man")
    first = _dump(tmp_path, "a.xml", [(i, 1, f"old {i}") for i in range(5)])
    second = _dump(tmp_path, "b.xml", [(3, 2, "new 3"), (7, 2, "new 7"), (8, 2, "new 8")])
    assert jobs.ingest_dump(spark, first, out, man) == 5
    assert jobs.ingest_dump(spark, second, out, man) == 3
    docs = {r.source_id: (r.version, r.text) for r in records.read_documents(spark, out, fmt="parquet").collect()}
    assert docs == {"0": ("1", "old 0"), "1": ("1", "old 1"), "2": ("1", "old 2"), "3": ("2", "new 3"), "4": ("1", "old 4"),
                    "7": ("2", "new 7"), "8": ("2", "new 8")}
    # Each run logs its own pages only.
    assert sorted(r["source_id"] for r in spark.read.json(man).collect()) == ["0", "1", "2", "3", "3", "4", "7", "8"]


def test_last_page_in_dump_order_wins(spark, tmp_path):
    path = _dump(tmp_path, "d.xml", [(1, 9, "nine"), (1, 10, "ten"), (2, 10, "ten"), (2, 9, "nine")])
    jobs.ingest_dump(spark, path, str(tmp_path / "docs"), str(tmp_path / "man"))
    docs = {r.source_id: r.text for r in records.read_documents(spark, str(tmp_path / "docs"), fmt="parquet").collect()}
    assert docs == {"1": "ten", "2": "nine"}


def test_chunk_and_embedding_sinks_keep_other_ids(spark, tmp_path):
    chunks, vecs, man = str(tmp_path / "chunks"), str(tmp_path / "vecs"), str(tmp_path / "man")
    docs = [spark.createDataFrame([(f"d{i}", "s", str(i), "T", "1", "", f"text {i} {word}", {})], records.DOCUMENT_SCHEMA)
            for i, word in ((1, "old"), (2, "old"), (1, "new"))]
    for d in docs:
        jobs.chunk_documents_job(d, chunks, man)
    got = {r.chunk_id: r.text for r in records.read_chunks(spark, chunks, fmt="parquet").collect()}
    assert got == {"d1_chunk_0": "text 1 new", "d2_chunk_0": "text 2 old"}
    table = records.read_chunks(spark, chunks, fmt="parquet")
    for part in (table.filter("document_id = 'd1'"), table.filter("document_id = 'd2'"), table.filter("document_id = 'd1'")):
        assert jobs.embed_chunks_job(part, HashingEncoder(8), vecs, str(tmp_path / "vman")) == 1
    assert sorted(r.record_id for r in records.read_vector_records(spark, vecs, fmt="parquet").collect()) == \
        ["d1_chunk_0", "d2_chunk_0"]
    assert spark.read.json(str(tmp_path / "vman")).count() == 3


def test_malformed_page_is_an_error(spark, tmp_path):
    path = tmp_path / "bad.xml"
    path.write_text("<mediawiki><page><title>A</title><id>1</id><revision><id>1</id><text>x</text></revision></page>"
                    "<page><title>B</title><id>2</id><revision><id>2</id><text>x</revision></page></mediawiki>")
    with pytest.raises(Exception, match="MALFORMED|malformed"):
        jobs.ingest_dump(spark, str(path), str(tmp_path / "docs"), str(tmp_path / "man"))


def test_stream_chunks_equal_batch(spark, tmp_path):
    from sparkretrieve.operators import chunking
    from sparkretrieve.streaming.ingest import run_chunk_stream

    landing = str(tmp_path / "landing")
    _docs(spark).repartition(2).write.parquet(landing)
    chunks, manifest = run_chunk_stream(spark, landing, str(tmp_path / "out"), chunk_size=200, chunk_overlap=20,
                                        max_files_per_trigger=1, checkpoint=str(tmp_path / "ckpt"))
    batch = chunking.chunk_documents(_docs(spark), 200, 20)
    key = ["chunk_id", "text"]
    assert sorted(chunks.select(*key).collect()) == sorted(batch.select(*key).collect())
    assert manifest.count() == chunks.count()


def test_stream_replaces_and_withdraws_chunks_and_survives_replays(spark, tmp_path):
    from sparkretrieve.operators import chunking
    from sparkretrieve.streaming import ingest

    landing, out, ckpt = (str(tmp_path / n) for n in ("landing", "out", "ckpt"))

    def doc(i, text):
        return (f"d{i}", "s", str(i), "T", "1", "", text, {"a": "1", "b": "2"})

    def run():
        return ingest.run_chunk_stream(spark, landing, out, chunk_size=40, chunk_overlap=0, checkpoint=ckpt)

    def land(*docs):
        frame = spark.createDataFrame(list(docs), records.DOCUMENT_SCHEMA)
        frame.coalesce(1).write.mode("append").parquet(landing)
        return frame

    first = {i: f"some words of document {i}. " * (4 if i == 1 else 1) for i in range(4)}
    land(*[doc(i, t) for i, t in first.items()])
    chunks, manifest = run()
    emitted = manifest.count()
    assert emitted == chunks.count() > 4
    # The same again, one shorter, one new, one now blank.
    land(doc(0, first[0]), doc(1, "short."), doc(9, "new words"), doc(2, "  "))
    chunks, manifest = run()
    want = {**first, 1: "short.", 9: "new words", 2: "  "}
    batch = chunking.chunk_documents(spark.createDataFrame([doc(i, t) for i, t in want.items()], records.DOCUMENT_SCHEMA), 40, 0)
    assert sorted(chunks.select("chunk_id", "text").collect()) == sorted(batch.select("chunk_id", "text").collect())
    assert manifest.count() == emitted + 2  # unchanged documents emit nothing
    versions = [ingest.RecordTable(spark, f"{out}/{n}").version for n in ("chunks", "states")]
    # A batch that is run once more finds nothing to do.
    again = spark.createDataFrame([doc(1, "short."), doc(9, "new words")], records.DOCUMENT_SCHEMA) \
        .selectExpr("*", "current_timestamp() as _time", "'p' as _path")
    assert ingest.apply_documents(again, out, 40, 0, f"{out}/manifest/stream=x/batch_id=1") == 0
    assert [ingest.RecordTable(spark, f"{out}/{n}").version for n in ("chunks", "states")] == versions
    # One that died after the chunks, before the state, is repeated with the same result.
    states = ingest.RecordTable(spark, f"{out}/states")
    (tmp_path / "out" / "states" / "_versions" / f"{states.version:010d}.json").unlink()
    repeat = spark.createDataFrame([doc(0, first[0]), doc(1, "short."), doc(9, "new words"), doc(2, "  ")], records.DOCUMENT_SCHEMA) \
        .selectExpr("*", "current_timestamp() as _time", "'p' as _path")
    assert ingest.apply_documents(repeat, out, 40, 0) == 3
    assert sorted(ingest.RecordTable(spark, f"{out}/chunks").rows().select("chunk_id", "text").collect()) == \
        sorted(batch.select("chunk_id", "text").collect())


def test_last_of_repeated_pages_without_shuffling_whole_rows(spark):
    rows = [("a", 1, "x"), ("a", 3, "y"), ("a", 2, "z"), ("b", 4, "x"), (None, 5, "x"), (None, 6, "y")]
    batch = spark.createDataFrame(rows, "id string, pos int, text string")
    want = [("a", 3, "y"), ("b", 4, "x"), (None, 6, "y")]
    assert sorted(map(tuple, jobs.last_written_per_id(batch, "id", "pos").collect()), key=str) == sorted(want, key=str)
    alone = batch.filter("pos in (1, 4, 5)")
    assert sorted(map(tuple, jobs.last_written_per_id(alone, "id", "pos").collect()), key=str) == sorted([rows[0], rows[3], rows[4]], key=str)
