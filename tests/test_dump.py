import bz2

from sparkretrieve.sources import dump

HEADER = '<mediawiki xmlns="http://www.mediawiki.org/xml/export-0.10/" xml:lang="en">\n<siteinfo><sitename>W</sitename></siteinfo>\n'
PAGE = """  <page>
    <title>{title}</title>
    <ns>0</ns>
    <id>{pid}</id>
    {rev}
  </page>
"""
REV = """<revision>
      <id>{rid}</id>
      <parentid>5</parentid>
      <timestamp>2024-04-15T14:38:04Z</timestamp>
      <contributor><username>u</username><id>99</id></contributor>
      <text bytes="3" xml:space="preserve">{text}</text>
    </revision>"""


def _dump(tmp_path, pages, name="dump.xml.bz2"):
    body = HEADER + "".join(pages) + "</mediawiki>\n"
    p = tmp_path / name
    p.write_bytes(bz2.compress(body.encode("utf-8")))
    return str(p)


def test_single_page(spark, tmp_path):
    path = _dump(tmp_path, [PAGE.format(title="Tides", pid="1",
                                        rev=REV.format(rid="10", text="Tides follow the moon twice a day."))])
    rows = dump.read_pages(spark, path).collect()
    assert len(rows) == 1
    r = rows[0]
    assert (r.title, r.page_id, r.revision_id, r.timestamp, r.text) == (
        "Tides", "1", "10", "2024-04-15T14:38:04Z", "Tides follow the moon twice a day.")


def test_validity_rules_entities_and_spaces(spark, tmp_path):
    pages = [
        PAGE.format(title="NoRevision", pid="2", rev=""),
        PAGE.format(title="", pid="3", rev=REV.format(rid="11", text="x")),
        PAGE.format(title="Empty", pid="4", rev=REV.format(rid="12", text="")),
        PAGE.format(title="A &amp; B", pid="5", rev=REV.format(rid="13", text="  a &lt;b&gt; &amp; c  ")),
    ]
    rows = {r.page_id: r for r in dump.read_pages(spark, _dump(tmp_path, pages)).collect()}
    assert set(rows) == {"4", "5"}
    assert rows["4"].text == ""
    assert rows["5"].title == "A & B" and rows["5"].text == "  a <b> & c  "
    assert rows["5"].revision_id == "13"


def test_limit_counts_valid_pages_only(spark, tmp_path):
    pages = [PAGE.format(title="Bad", pid="1", rev="")] + [
        PAGE.format(title=f"T{i}", pid=str(i), rev=REV.format(rid=str(100 + i), text="t")) for i in range(2, 6)]
    rows = dump.read_pages(spark, _dump(tmp_path, pages), limit=2).collect()
    assert [r.page_id for r in rows] == ["2", "3"]


def test_page_to_document_and_manifest(spark, tmp_path):
    path = _dump(tmp_path, [PAGE.format(title="AccessibleComputing", pid="10",
                                        rev=REV.format(rid="1219062925", text="#REDIRECT [[Computer accessibility]]"))])
    doc = dump.pages_to_documents(dump.read_pages(spark, path)).first()
    assert (doc.document_id, doc.source, doc.source_id, doc.version) == ("wikipedia_10", "wikipedia", "10", "1219062925")
    assert doc.metadata == {"page_id": "10", "revision_id": "1219062925"}
    man = dump.ingest_manifest(dump.pages_to_documents(dump.read_pages(spark, path)), "out").first()
    assert man.output_path == "out/wikipedia_10.json" and man.status == "saved"


def test_many_pages_many_files(spark, tmp_path):
    pages = [PAGE.format(title=f"T{i}", pid=str(i), rev=REV.format(rid=str(i), text="w " * (i % 50)))
             for i in range(1, 2001)]
    _dump(tmp_path, pages[:1000], "a.xml.bz2")
    _dump(tmp_path, pages[1000:], "b.xml.bz2")
    df = dump.read_pages(spark, str(tmp_path))
    assert df.count() == 2000 and df.select("page_id").distinct().count() == 2000


def test_bz2_dump_split_into_many_tasks_keeps_every_page_once(spark, tmp_path):
    import random

    rnd = random.Random(5)
    words = ["alpha", "beta", "gamma", "delta", "eps", "zeta", "eta", "theta", "iota", "kappa"]
    pages = []
    for i in range(1, 3001):
        text = " ".join(rnd.choice(words) + str(rnd.randint(0, 99999)) for _ in range(60))
        pages.append(PAGE.format(title=f"T{i}", pid=str(i), rev=REV.format(rid=str(10 * i), text=text)))
    body = HEADER + "".join(pages) + "</mediawiki>\n"
    path = tmp_path / "big.xml.bz2"
    path.write_bytes(bz2.compress(body.encode("utf-8"), compresslevel=1))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(96 * 1024))
    try:
        lines = spark.read.option("lineSep", "</page>").text(str(path))
        assert lines.rdd.getNumPartitions() > 3
        df = dump.read_pages(spark, str(path))
        rows = df.select("page_id", "revision_id").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert len(rows) == 3000
    assert {r.page_id for r in rows} == {str(i) for i in range(1, 3001)}
    assert all(r.revision_id == str(10 * int(r.page_id)) for r in rows)


def _revisions(spark, path):
    return [(r.page_id, r.revision_id) for r in dump.read_pages(spark, path, with_position=True).orderBy("pos").collect()]


def test_order_is_path_then_offset_whatever_the_sizes(spark, tmp_path):
    from sparkretrieve.plans import jobs
    from sparkretrieve.sources import records

    for small, large in ((1, 2), (2, 1)):
        folder = tmp_path / f"dump{small}"
        folder.mkdir()
        for part in (1, 2):
            text = "x" * (50 if part == small else 50_000)
            (folder / f"part-{part}.xml").write_text(HEADER + PAGE.format(title="T", pid="7", rev=REV.format(rid=str(part), text=text)) + "</mediawiki>")
        assert _revisions(spark, str(folder)) == [("7", "1"), ("7", "2")]
        assert [r.revision_id for r in dump.read_pages(spark, str(folder), 1).collect()] == ["1"]
        jobs.ingest_dump(spark, str(folder), str(tmp_path / f"docs{small}"), str(tmp_path / f"man{small}"))
        assert [r.version for r in records.read_documents(spark, str(tmp_path / f"docs{small}"), fmt="parquet").collect()] == ["2"]


def test_a_limit_reads_a_few_splits_of_a_large_file(spark, tmp_path):
    path = tmp_path / "large.xml"
    path.write_text(HEADER + "".join(PAGE.format(title=f"T{i}", pid=str(i), rev=REV.format(rid="1", text="word " * 40)) for i in range(1000)) + "</mediawiki>")
    keep = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        assert dump.read_pages(spark, str(path)).rdd.getNumPartitions() > 40
        assert _revisions(spark, str(path)) == [(str(i), "1") for i in range(1000)]
        tracker = spark.sparkContext.statusTracker()
        spark.sparkContext.setJobGroup("few-splits", "limit")
        got = dump.read_pages(spark, str(path), 5)
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        tasks = sum(tracker.getStageInfo(s).numTasks for j in tracker.getJobIdsForGroup("few-splits") for s in tracker.getJobInfo(j).stageIds)
        assert [r.page_id for r in got.collect()] == ["0", "1", "2", "3", "4"] and tasks <= 6
        many = dump.read_pages(spark, str(path), 300)
        assert sorted(int(r.page_id) for r in many.collect()) == list(range(300))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", keep[0])
        spark.conf.set("spark.sql.files.openCostInBytes", keep[1])
