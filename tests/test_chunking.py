import pytest
from pyspark.sql import functions as F

from sparkretrieve.operators import chunking
from sparkretrieve.operators.chunking import split_text


@pytest.mark.parametrize(
    "text,size,overlap,expected",
    [
        ("aa bb cc dd ee ff", 8, 3, ["aa bb cc", "cc dd", "dd ee", "ee ff"]),
        ("para one\n\npara two is long\n\nx", 12, 4, ["para one", "para two is", "is long", "x"]),
        ("abcdefghij", 4, 1, ["abcd", "defg", "ghij"]),
        ("One. Two. Three. Four", 10, 5, ["One. Two", ". Three", ". Four"]),
        ("   \n  ", 10, 2, []),
        ("", 10, 2, []),
    ],
)
def test_split_goldens(text, size, overlap, expected):
    assert split_text(text, size, overlap) == expected


def _words(a, b):
    return " ".join(f"w{i:02d}" for i in range(a, b + 1))


def test_split_words_golden():
    """Pieces are 3, then 4 characters: five words fill 19. At most 7 stay, which
    is one piece, so every later chunk starts with the last word of the one
    before and takes three more."""
    chunks = split_text(_words(0, 29), 19, 7)
    assert chunks == [_words(0, 4), *[_words(k, k + 3) for k in range(4, 28, 3)], _words(28, 29)]


def test_strip_is_unicode():
    assert split_text(" abc　", 10, 0) == ["abc"]


@pytest.mark.parametrize(
    "size,overlap,message",
    [
        (0, 0, "chunk_size must be greater than 0"),
        (10, -1, "chunk_overlap cannot be negative"),
        (10, 10, "chunk_overlap must be smaller than chunk_size"),
    ],
)
def test_guards(size, overlap, message):
    with pytest.raises(ValueError, match=message):
        chunking.split_text_column("text", size, overlap)


def _doc(spark, text, metadata=None):
    return spark.createDataFrame(
        [("wikipedia_1", "wikipedia", "1", "Tides", "10", "2024-04-15T14:38:04Z", text,
          metadata or {"page_id": "1", "revision_id": "10"})],
        "document_id string, source string, source_id string, title string, version string, "
        "updated_at string, text string, metadata map<string,string>",
    )


def test_chunk_records_lineage(spark):
    text = _words(0, 29)
    rows = chunking.chunk_documents(_doc(spark, text), 19, 7).orderBy("chunk_index").collect()
    assert len(rows) > 1
    first = rows[0]
    assert first.chunk_id == "wikipedia_1_chunk_0"
    assert first.document_id == "wikipedia_1"
    assert first.chunk_index == 0
    meta = first.metadata
    assert meta["chunk_id"] == "wikipedia_1_chunk_0"
    assert meta["chunk_index"] == "0"
    assert set(meta) == {"document_id", "source", "source_id", "title", "version", "updated_at",
                         "page_id", "revision_id", "chunk_index", "chunk_id"}
    assert [r.text for r in rows] == split_text(text, 19, 7)


def test_metadata_title_override_reaches_columns(spark):
    rows = chunking.chunk_documents(_doc(spark, "hello world", {"title": "Other"}), 100, 0).collect()
    assert rows[0].title == "Other"
    assert rows[0].metadata["title"] == "Other"
    assert rows[0].chunk_id == "wikipedia_1_chunk_0"


def test_summary_counts_empty_documents(spark):
    docs = _doc(spark, "a b c").unionByName(_doc(spark, "   ").withColumn("document_id", F.lit("wikipedia_2")))
    row = chunking.chunk_summary(chunking.split_documents(docs, 100, 0)).collect()[0]
    assert (row.documents_processed, row.chunks_saved) == (2, 1)


def test_manifest(spark):
    chunks = chunking.chunk_documents(_doc(spark, "a b c"), 100, 0)
    row = chunking.chunk_manifest(chunks, "out/chunks").collect()[0]
    assert row.asDict() == {"document_id": "wikipedia_1", "chunk_id": "wikipedia_1_chunk_0",
                            "output_path": "out/chunks/wikipedia_1_chunk_0.json", "status": "saved"}


def test_short_text_is_one_stripped_chunk():
    text = "  A short document.\nWith two lines.  "
    assert split_text(text, 1200, 200) == [text.strip()]


def test_long_batches_are_split_in_parts(spark):
    """A worker makes Python objects of about a megabyte of text at a time, whatever the batch."""
    import pyarrow as pa

    from sparkretrieve.functions.batches import PART_BYTES, parts_of

    texts = pa.array(["x" * 300_000] * 10 + [None, "", "y" * 3_000_000] + ["z"] * 100)
    parts = list(parts_of(texts))
    assert [a for a, _ in parts] == [0, *[a + n for a, n in parts][:-1]] and sum(n for _, n in parts) == len(texts)
    sizes = [sum(len(t or "") for t in texts.slice(a, n).to_pylist()) for a, n in parts]
    assert max(s for s, (_, n) in zip(sizes, parts, strict=True) if n > 1) < PART_BYTES + 3_000_100 and len(parts) == 4
    assert list(parts_of(pa.array([], pa.string()))) == []
    rows = [(f"d{i}", f"a {i} b. " * (i * 400) if i % 7 else None) for i in range(40)]
    docs = spark.createDataFrame(rows, "document_id string, text string").coalesce(1).selectExpr(
        "document_id", "'s' as source", "document_id as source_id", "'t' as title", "'1' as version", "'' as updated_at", "text",
        "map('k', 'v') as metadata")
    got = {r.document_id: r.chunks for r in chunking.split_documents(docs).collect()}
    assert got == {i: chunking.split_text(t) for i, t in rows}
