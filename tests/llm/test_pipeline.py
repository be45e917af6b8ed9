"""Every stage of the pipeline on the smallest test tables, against a plain version of it."""

import hashlib
import re

import public_tokenizers
import pytest
import tiktoken
from brute_force import by_definition, groups_of

import corpus_pipeline
from star_marts.llm import byte_bpe, secret_scan, simhash_dedup, source_mixing, toxicity
from star_marts.llm.common import table
from star_marts.session import stage

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def inputs(spark):
    """The input of each stage, and the last stage's result, as rows by name."""
    docs = table(spark, SF_DIR, "documents")
    columns = docs.columns
    out = {}
    for name, apply in corpus_pipeline.STAGES:
        out[name] = (docs, docs.collect())
        docs = stage(apply(spark, docs, SF_DIR), "test")
        if name != "byte_bpe":
            assert docs.columns == columns
    out["end"] = (docs, docs.collect())
    return out


def test_stages():
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "toxicity", "simhash_near_dedup", "secret_scan", "source_mixing", "byte_bpe",
    ]


def test_toxicity(spark, inputs):
    docs, rows = inputs["toxicity"]
    net = toxicity.train(*toxicity.training_sample(docs, table(spark, SF_DIR, "labels")))
    scorer = toxicity.Scorer(net)
    want = {r for r in rows if scorer.scores([r.text.encode()])[0] < toxicity.THRESHOLD}
    assert set(inputs["simhash_near_dedup"][1]) == want


def test_near_duplicates(inputs):
    rows = inputs["simhash_near_dedup"][1]
    fps = {r.doc_id: by_definition(r.text) for r in rows}
    reach = groups_of(fps.values())
    want = {r for r in rows if r.doc_id == min(i for i, f in fps.items() if f in reach[fps[r.doc_id]])}
    assert set(inputs["secret_scan"][1]) == want


def test_secrets(inputs):
    docs, rows = inputs["secret_scan"]
    spans = {r.doc_id: r.spans for r in secret_scan.scan(docs).collect()}
    after = {r.doc_id: r for r in inputs["source_mixing"][1]}
    assert len(after) == len(rows)
    for r in rows:
        text, found = r.text, [tuple(map(int, s.split(":")[1:])) for s in spans[r.doc_id].split(",") if s]
        hidden = sorted({i for a, b in found for i in range(a, b)})
        runs = [(i, j) for i in hidden if i - 1 not in hidden for j in hidden if j >= i and j + 1 not in hidden]
        for i in {i for i, _ in runs}:
            end = min(j for k, j in runs if k == i)
            text = text.replace(r.text[i : end + 1], "[secret]", 1)
        assert after[r.doc_id].text == text and after[r.doc_id].n_chars == (len(text) if found else r.n_chars)
        assert not re.search(r"AKIA[A-Z0-9]{16,}|[0-9a-f]{24,}", after[r.doc_id].text)


def test_mix(inputs):
    docs, rows = inputs["source_mixing"]
    taken = {r.doc_id: r.taken for r in source_mixing.mix(docs).collect()}
    after = {r.doc_id: r for r in inputs["byte_bpe"][1]}
    count = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t))
    assert set(after) == {i for i, n in taken.items() if n}
    before = {r.doc_id: r for r in rows}
    for i, r in after.items():
        assert count(r.text) == taken[i] and r.n_chars == len(r.text)
        assert set(r.text.split()) <= set(before[i].text.split())
        if taken[i] == count(before[i].text) and r.text != before[i].text:
            assert r.text.split() != before[i].text.split() or "\n" in r.text


def test_tokens(inputs):
    library = tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=byte_bpe.text_encoder().encoder.ranks,
        special_tokens={},
    )
    texts = {r.doc_id: r.text for r in inputs["byte_bpe"][1]}
    for r in inputs["end"][1]:
        ids = library.encode_ordinary(texts.pop(r.doc_id))
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.n_tokens == len(ids)
    assert not texts


def test_run_gives_the_same(spark, inputs):
    assert sorted(corpus_pipeline.run(spark, SF_DIR).collect()) == sorted(inputs["end"][1])


def test_fingerprints_use_three_words_and_three_bits():
    assert (simhash_dedup.SHINGLE, simhash_dedup.DISTANCE) == (3, 3)
