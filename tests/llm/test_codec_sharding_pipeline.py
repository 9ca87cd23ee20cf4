"""BPE against the library, sharding properties, the pipeline against brute force."""

import collections
import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from sparkretrieve.llm import bpe, sharding
from sparkretrieve.llm.common import table
from sparkretrieve.llm.queries import tokenizer_path
from tests.llm.test_text_operators import _components, _cut_lines, _fingerprint

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(tokenizer_path())


def _odd_texts():
    rng = random.Random(1)
    pool = "ab  \n\t'sreLMé²½ⅧÀß_-\x85\xa0\x1c 　日本𝔸́ͅ٣🙂€…“”0123\x00​﻿"
    texts = ["".join(rng.choice(pool) for _ in range(rng.randint(0, 14))) for _ in range(1500)]
    texts += [x + "<|endoftext|>" + x for x in texts[:50]]
    return texts + ["", " ", "a" * 5000, "ab" * 3000 + " " * 4000 + "x", "é" * 2000, "the" * 1500, "<|endoftext|>"]


def test_codec_equals_the_library(tokenizer):
    codec = bpe.BpeCodec(tokenizer_path())
    for x in _odd_texts():
        want = tokenizer.encode(x, add_special_tokens=False).ids
        assert codec.encode(x) == want
        assert codec.decode(want) == tokenizer.decode(want, skip_special_tokens=False)


def test_long_and_short_words_merge_alike():
    codec = bpe.BpeCodec(tokenizer_path())
    rng = random.Random(2)
    for _ in range(300):
        word = "".join(rng.choice("abethrn é") for _ in range(rng.randint(1, 60))).encode()
        assert codec._merge_long(word) == codec._merge_short(word)


def test_encode_and_decode_tables(spark, tokenizer):
    rows = [(1, None, "x", 1), (2, "", "x", 1), (3, "Hello  world\n", "x", 1), (3, "Hello  world\n", "x", 1), (None, "é " * 9000, "x", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string, n_tokens int")
    coded = bpe.encode_texts(docs, tokenizer_path())
    assert coded.columns == ["doc_id", "text", "n_tokens", "ids"]
    back = bpe.decode_ids(coded, tokenizer_path()).collect()
    assert [r.decoded for r in back] == [t or "" for _, t, _, _ in rows]
    assert [r.ids for r in back] == [tokenizer.encode(t or "").ids for _, t, _, _ in rows]
    assert bpe.decode_ids(docs.select(F.lit(None).cast("array<int>").alias("ids")), tokenizer_path()).first().decoded == ""
    assert bpe.round_trip_digests(docs.limit(0), tokenizer_path()).count() == 0


def test_lookup_table_is_even_and_stable():
    names = [f"s{k}" for k in range(20)]
    before = sharding.lookup_table(names, 10_007)
    sizes = collections.Counter(before)
    assert set(sizes) == set(range(20)) and max(sizes.values()) - min(sizes.values()) <= 1
    after = sharding.lookup_table(names[:-1], 10_007)
    moved = sum(a != b for a, b in zip(before, after, strict=True) if a != 19)
    assert moved / 10_007 < 0.1
    weighted = collections.Counter(sharding.lookup_table(["a", "b"], 10_007, [3, 1]))
    assert weighted[0] / weighted[1] == pytest.approx(3, rel=0.01)


def test_lookup_table_takes_turns():
    """Each claim is the first free slot of the shard's order, in turn."""
    names, slots = ["x", "y", "z"], 31
    table_, taken = sharding.lookup_table(names, slots), {}
    orders = [[(sharding._number(f"start:{n}") + j * (sharding._number(f"stride:{n}") % (slots - 1) + 1)) % slots
               for j in range(slots)] for n in names]
    for turn in range(slots):
        k = turn % 3
        taken[next(s for s in orders[k] if s not in taken)] = k
    assert [taken[s] for s in range(slots)] == table_


@pytest.mark.parametrize("bad", [([], 31, None), (["a", "a"], 31, None), (["a"], 32, None), (["a"], 31, [0]), (["a", "b"], 2, [2, 1])])
def test_lookup_table_rejects(bad):
    with pytest.raises(ValueError):
        sharding.lookup_table(*bad)


def test_assign_shards(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (None, "b"), (2, "c")], "doc_id long, shard string")
    got = sharding.assign_shards(df, F.col("doc_id"), ["p", "q"], 101).collect()
    assert len(got) == 4 and all(r.shard in ("p", "q") for r in got)
    assert len({r.slot for r in got if r.doc_id == 1}) == 1
    assert sharding.assign_shards(df.limit(0), F.col("doc_id"), ["p"], 101).count() == 0


def test_pipeline_stages(spark, tokenizer):
    docs = table(spark, SF, "documents")
    odd = [(90_001, None, None, None, None), (90_002, "", "en", "s", 0), (90_003, "same text twice", "en", "s", 15),
           (90_003, "same text twice", "en", "s", 15)]
    docs = docs.union(spark.createDataFrame(odd, docs.schema))
    seen = [docs]
    for name, stage in corpus_pipeline.STAGES:
        seen.append(corpus_pipeline.materialise(stage(spark, seen[-1], SF), name))
    before, clean, cut, single, packed = ([tuple(r) for r in d.collect()] for d in seen)
    assert all(d.columns == docs.columns for d in seen[:-1])
    # Toxicity: rows as they were; nearly all labelled documents rightly judged.
    assert not collections.Counter(clean) - collections.Counter(before)
    labels = {r.doc_id: r.toxic for r in table(spark, SF, "labels").collect()}
    stay = {r[0] for r in clean}
    right = [(i in stay) == (labels[i] == 0) for i in {r[0] for r in before} & set(labels)]
    assert sum(right) / len(right) >= 0.9
    # Line dedup.
    want = _cut_lines([(i, t) for i, t, *_ in clean])
    assert sorted((str(i), t) for i, t, *_ in cut) == sorted((i, t) for i, _, _, t in want)
    assert all(n == len(t) for _, t, _, _, n in cut if n is not None)
    # SimHash: the smallest identifier of each group.
    roots = _components([_fingerprint(t) for _, t, *_ in cut], 2)
    least = {}
    for i, t, *_ in cut:
        r = roots[_fingerprint(t)]
        least[r] = min(least.get(r, i), i)
    assert sorted(r[0] for r in single) == sorted(least.values())
    assert not collections.Counter(single) - collections.Counter(cut)
    # Packing: every id of every document, once, in sequences without gaps.
    total = {i: len(tokenizer.encode(t or "", add_special_tokens=False).ids) + 1 for i, t, *_ in single}
    got = collections.Counter()
    ends = collections.defaultdict(list)
    for i, _, _, length, _, sequence, offset in packed:
        got[i] += length
        ends[sequence].append((offset, length))
    assert got == total
    for parts in ends.values():
        assert np.cumsum([0] + [n for _, n in sorted(parts)])[:-1].tolist() == sorted(o for o, _ in parts)
        assert sum(n for _, n in parts) <= 2048
    assert len(ends) <= -(-sum(total.values()) // 2048) * 1.02 + 1


def test_pipeline_of_nothing(spark):
    docs = table(spark, SF, "documents").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.materialise(stage(spark, docs, SF), "empty")
    assert docs.count() == 0
