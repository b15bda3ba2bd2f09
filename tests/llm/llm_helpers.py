"""Shared by the tests of this folder: comparison with DuckDB over the given tables."""

import random

import duckdb
from compare import compare, type_mismatches

from cartwheel.llm.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"


def check_oracle(spark, name, sf_dir):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "benchmark", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    df = QUERIES[name](spark, sf_dir)
    assert compare(df, con, ORACLE[name]) == []
    assert type_mismatches(df, con, ORACLE[name]) == []


def prose(rng: random.Random, words: int) -> str:
    vocabulary = [a + b for a in ("ka", "lo", "mi", "tu", "re", "so") for b in ("n", "ra", "vel", "dis", "pom", "que")]
    return " ".join(rng.choice(vocabulary) for _ in range(words))
