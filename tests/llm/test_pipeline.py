"""The pipeline's stages, each on what its predecessor kept, against the brute-force versions."""

import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline as cp
from regioncast.llm import toxicity
from regioncast.llm.common import stored, table
from tests.llm.helpers import SF, sf_rows
from tests.llm.test_decontaminate import brute as contaminated
from tests.llm.test_line_dedup import brute as line_brute
from tests.llm.test_simhash import brute_components, brute_fingerprint
from tests.llm.test_tokens import _check_pieces


@pytest.fixture(scope="module")
def stages(spark):
    docs, out = table(spark, SF, "documents"), []
    for name, stage in cp.STAGES:
        got = stored(stage(spark, docs, SF), name)
        out.append((docs, got))
        docs = got
    return out


def rows_of(df):
    return {r.doc_id: r.text for r in df.select("doc_id", "text").collect()}


def test_columns_and_names(stages):
    columns = ["doc_id", "text", "lang", "source", "n_chars"]
    assert [len(cp.STAGES), cp.ORACLE_SQL] == [5, None]
    assert all(sorted(got.columns) == sorted(columns) for _, got in stages[:-1])


def test_toxic_documents_go(spark, stages):
    docs, got = stages[0]
    scores = toxicity.toxicity_scores(docs, table(spark, SF, "labels")).collect()
    assert set(rows_of(got)) == {r.doc_id for r in scores if not r.predicted}
    assert len(rows_of(got)) < docs.count()


def test_repeated_chunks_go(stages):
    import hashlib

    docs, got = stages[1]
    kept = {r.doc_id: r for r in got.collect()}
    for doc_id, _, gone, digest in line_brute(list(rows_of(docs).items())):
        r = kept[doc_id]
        assert hashlib.sha256(r.text.encode()).hexdigest() == digest and (not gone or r.n_chars == len(r.text))


def test_one_of_each_group_stays(stages):
    docs, got = stages[2]
    rows = list(rows_of(docs).items())
    ids = [d for d, _ in rows]
    comp = brute_components([brute_fingerprint(t) for _, t in rows], ids)
    assert set(rows_of(got)) == set(comp)
    assert rows_of(got).items() <= rows_of(docs).items()


def test_contaminated_documents_go(stages):
    docs, got = stages[3]
    rows = list(rows_of(docs).items())
    clean = {d for d, n, hit, _ in contaminated(rows, sf_rows("benchmark", "item_id, text")) if not (hit and 20 * hit >= n)}
    assert set(rows_of(got)) == clean and len(clean) < len(rows)
    assert rows_of(got).items() <= rows_of(docs).items()


def test_pieces_hold_all_that_is_left(stages):
    docs, got = stages[4]
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rows = got.collect()
    _check_pieces(rows, rows_of(docs), lambda x: t.encode(x or "", add_special_tokens=False).ids)


def test_run_gives_the_last_stage(spark, stages):
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    want = sorted(map(tuple, stages[4][1].select(*columns).collect()))
    assert sorted(map(tuple, cp.run(spark, SF).select(*columns).collect())) == want
