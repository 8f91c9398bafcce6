import numpy as np
import pyarrow.parquet as pq
import pytest
import tiktoken

import corpus_pipeline
from eventmart.llm import packing
from eventmart.session import stage
from tests.llm.test_line_rules import brute as line_counts
from tests.llm.test_mixing import brute_targets
from tests.llm.test_simhash import brute_classes, brute_print


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Documents before and after each stage, over the first rows of the small tables and some odd ones."""
    folder = str(tmp_path_factory.mktemp("tables"))
    small = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{small}/documents.parquet")
    item = pq.read_table(f"{small}/benchmark.parquet").to_pylist()[0]["text"]
    own = "\n".join(" ".join(f"q{i}z{k}" for k in range(12)) + "." for i in range(20))
    odd = spark.createDataFrame(
        [(9001, own, "en", "src1", 1), (9002, own, "en", None, 1), (9003, own.replace("q", "r") + "\n" + item, "en", "src1", 1), (9004, None, None, None, None)],
        docs.schema,
    )
    docs.unionByName(odd).write.parquet(f"{folder}/documents.parquet")
    spark.read.parquet(f"{small}/benchmark.parquet").write.parquet(f"{folder}/benchmark.parquet")
    out = [spark.read.parquet(f"{folder}/documents.parquet")]
    for _, step in corpus_pipeline.STAGES:
        out.append(stage(step(spark, out[-1], folder)))
    return folder, out


def ids(df):
    return sorted(r.doc_id for r in df.select("doc_id").collect())


def test_each_stage_works_on_what_the_one_before_kept(stages):
    _, (raw, clean, single, fair, mixed, packed) = stages
    assert all(x.columns == raw.columns for x in (clean, single, fair, mixed))
    texts = {r.doc_id: r.text for r in raw.collect()}
    for doc in set(texts) - set(ids(clean)):
        n, *_ = line_counts(texts[doc])
        assert n < 50 or doc not in (9001, 9002, 9003)
    prints = {r.doc_id: brute_print(r.text) for r in clean.collect()}
    assert ids(single) == sorted(set(brute_classes(prints).values()))
    assert 9002 not in ids(single) and 9003 in ids(single)
    assert 9003 not in ids(fair) and 9001 in ids(fair)
    sizes, source = {}, {}
    for r in fair.collect():
        n = len((r.text or "").encode().split())
        sizes[r.source] = sizes.get(r.source, 0) + n
        source[r.doc_id] = (r.source, n)
    want, taken = brute_targets(sizes), dict.fromkeys(sizes, 0)
    for doc in ids(mixed):
        taken[source[doc][0]] += source[doc][1]
    assert max(ids(mixed).count(d) for d in source) <= 2
    assert all(abs(taken[s] - want[s]) <= max(n for k, n in source.values() if k == s) for s in sizes)


def test_the_last_stage_holds_every_token(stages):
    _, (*_, mixed, packed) = stages
    ranks = packing.read_ranks(open(packing.VOCABULARY, "rb").read())
    plain = tiktoken.Encoding("p", pat_str=packing.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = sorted((r.doc_id, len(plain.encode_ordinary(r.text)) + 1) for r in mixed.collect())
    assert sum(n for _, n in want) == sum(r.n_tokens for r in packed.collect())
    got = {}
    for r in packing.unpacked(packed).collect():
        got.setdefault(r.doc_id, {})[r.start] = r.ids
    texts = {r.doc_id: r.text for r in mixed.collect()}
    for doc, parts in got.items():
        assert np.concatenate([parts[k] for k in sorted(parts)]).tolist() == plain.encode_ordinary(texts[doc]) + [packing.EOS]


def test_run_gives_what_the_stages_give(spark, stages):
    folder, out = stages
    assert sum(r.n_tokens for r in corpus_pipeline.run(spark, folder).collect()) == sum(r.n_tokens for r in out[-1].collect())
