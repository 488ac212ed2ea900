"""The pipeline's stages against plain versions of them."""

import hashlib
import re

import numpy as np

import corpus_pipeline
from quayside.llm.common import staged
from quayside.llm.quality import Scorer, held_out, train_quality
from test_jaccard import brute as components_of
from test_lines import brute as lines_of
from test_mixing import brute as mix_of
from quayside.llm.lines import MIN_SITES
from quayside.llm.mixing import DEFAULT_MIX, domain_of

SF = "/root/testdata/sf0.001"


def test_stages_against_brute_force(spark, vocab):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    named = dict(corpus_pipeline.STAGES)
    assert list(named) == ["quality", "lines", "near_duplicates", "mixing", "tokens"]
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = staged(stage(spark, docs, SF), name)
        assert out.columns == corpus_pipeline.COLUMNS and dict(out.dtypes) == dict(docs.dtypes)
        kept[name] = (docs.collect(), out.collect())
        docs = out

    rows, out = kept["quality"]
    model = train_quality(spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet"), ~held_out())
    good = {r.doc_id for r, s in zip(rows, Scorer(model).score([r.text for r in rows])) if s >= 0.5}
    assert {r.doc_id for r in out} == good

    rows, out = kept["lines"]
    want = {i: t for i, (n, gone, t) in lines_of([(r.doc_id, r.text, r.source) for r in rows], MIN_SITES).items()
            if not (gone and not t.replace("\n", " ").strip(" "))}
    assert {r.doc_id: r.text for r in out} == want and all(r.n_chars == len(r.text) for r in out)

    rows, out = kept["near_duplicates"]
    assert {r.doc_id for r in out} == {i for i, _, c in components_of([(r.doc_id, r.text) for r in rows]) if i == c}
    assert len(out) == len({r.doc_id for r in out})

    rows, out = kept["mixing"]
    domain = {r.source: r.domain for r in docs.select("source", domain_of().alias("domain")).distinct().collect()}
    domain |= {r.source: r.domain for r in spark.createDataFrame([(s,) for s in {r.source for r in rows}], "source string")
               .select("source", domain_of().alias("domain")).collect()}
    copies = mix_of([(r.doc_id, r.text, r.lang, r.source, domain[r.source]) for r in rows], DEFAULT_MIX)
    assert sorted(r.doc_id for r in out) == sorted(i for i, n in copies.items() for _ in range(n))

    from quayside.llm.bpe import Codec

    full = Codec(vocab).full
    result = corpus_pipeline.run(spark, SF).collect()
    texts = {r.doc_id: r.text for r in out}
    assert sorted(r.doc_id for r in result) == sorted(r.doc_id for r in out)
    for r in result[:40]:
        assert np.frombuffer(r.ids, "<u4").tolist() == full.encode(texts[r.doc_id], add_special_tokens=False).ids


def token_rows(full, docs):
    """What the token stage must give for rows of (doc_id, text), by the library itself."""
    out = []
    for i, text in docs:
        ids = full.encode(text, add_special_tokens=False).ids
        packed = np.array(ids, "<u4").tobytes()
        decoded = full.decode(ids, skip_special_tokens=False)
        out.append((i, len(ids), hashlib.sha256(packed).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest(), packed))
    return sorted(out)


def test_every_token_row_of_run(spark, vocab):
    from quayside.llm.bpe import Codec

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = staged(stage(spark, docs, SF), name)
    want = token_rows(Codec(vocab).full, [(r.doc_id, r.text) for r in docs.collect()])
    result = corpus_pipeline.run(spark, SF).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "ids").collect()
    assert len(want) > 40 and sorted((*r[:4], bytes(r.ids)) for r in result) == want


def test_edge_rows_pass_every_stage(spark, tmp_path):
    long = "plain words of a text " * 4000
    rows = [(1, None, "en", "src1", 0), (2, "", None, None, None), (3, long, "en", "src1", 1), (3, long, "en", "src1", 1),
            (None, "no id at all here", "de", "src2", 3), (4, "x" * 30_000, "fr", "src2", 1), (5, "short", "en", "src1", 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    spark.read.parquet(f"{SF}/labels.parquet").write.parquet(f"{tmp_path}/labels.parquet")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        out = staged(stage(spark, docs, str(tmp_path)), name)
        assert out.count() >= 1
        docs = out if name != "tokens" else docs
    empty = spark.createDataFrame([], docs.schema)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, str(tmp_path)).count() == 0


def test_every_query_is_registered():
    import __spark_entry__ as entry

    names = entry.queries()
    assert "pipeline" in names
    for n in range(1, 11):
        assert sum(re.match(rf"op{n}_", x) is not None for x in names) == 1
