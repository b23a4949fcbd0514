"""Every registered query of the package on the small tables, against its SQL
where it has one."""

import duckdb
import pytest

import __spark_entry__ as E
import corpus_pipeline
from cairn.llm import registry
from cairn.session import TABLES, table_path
from tools.oracle_check import rows_of

SF = "/root/testdata/sf0.001"
#: What each query without SQL is compared with in this folder.
WITHOUT_SQL = {
    "op1_embedding_dedup": "test_embeddings_match_brute_force", "op2_license_scan": "test_notices_match_alignment_without_anchors",
    "op3_line_dedup": "test_lines_match_brute_force", "op5_secret_scan": "test_secrets", "op6_piece_codec": "test_pieces_match_the_library",
    "op7_packing": "test_packing", "op8_hilbert_shards": "test_shards_match_their_texts_and_prune", "op9_toxicity": "test_toxicity",
    "op10_minhash_dedup": "test_minhash_matches_brute_force", "op13_bpe_codec": "test_codec_matches_the_library"}


def test_names():
    names = set(registry.queries())
    assert {n.split("_")[0] for n in names} == {f"op{k}" for k in range(1, 14)} and len(names) == 13
    assert names - set(registry.oracle_sql()) == set(WITHOUT_SQL)
    assert names | {"pipeline"} <= set(E.queries())
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "line_dedup", "minhash_near_dedup", "secret_scan", "packing"]


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query(spark, name):
    df = registry.queries()[name](spark, SF)
    got = df.collect()
    assert got or name == "op2_license_scan"
    sql = registry.oracle_sql().get(name)
    if sql:
        con = duckdb.connect()
        for t in TABLES:
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{table_path(SF, t)}')")
        cur = con.execute(sql)
        cols = [d[0] for d in cur.description]
        assert sorted(df.columns) == sorted(cols)
        assert rows_of(df.columns, got, False) == rows_of(cols, cur.fetchall(), False)
