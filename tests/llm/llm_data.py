"""Shared data of the training-data operator tests: hand-made rows with nulls,
empty and long texts, ties, repeated rows and columns with clashing names."""

import random
import zlib

import duckdb
import numpy as np
import pytest

SF_SMALL, SF_CHECK = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
STRANGE = ["", " ", "  ", "a ", " a", "a  b", "\n\n\n", "a\n\nb", "a \nb", "\x00", "a\x1cb", "é", "İΣς", "ﬁ ½",
           "▁x ▁", "<|endoftext|> a<|endoftext|>", "<s> </s>", "don't I'll", "1234 5 ٢", "\U0001f600\U0001f600 汉字",
           "　x y z", "###!!! ***", "http://www.x.com/a?b=c&d", "x" * 5000, "long word " * 3000, "\r\n\t \r"]


def strange_texts(seed=0, more=300):
    rng = random.Random(seed)
    return STRANGE + ["".join(rng.choices([*STRANGE[:23], "the", " ", " and", "\n"], k=rng.randint(1, 12))) for _ in range(more)]


def real_texts():
    return [r[0] for r in duckdb.execute(f"SELECT text FROM '{SF_SMALL}/documents.parquet' ORDER BY doc_id").fetchall()]


def u32(ids):
    return np.asarray(ids, "<u4").tobytes()


def crc(ids):
    return zlib.crc32(u32(ids))


@pytest.fixture(scope="session")
def rows():
    """(doc_id, text): null ids and texts, repeated rows and ids, strange and real texts."""
    texts = [None, *strange_texts(), *real_texts()[:60]]
    out = [(k, t) for k, t in enumerate(texts)]
    return out + [(None, "a b c"), (None, None), out[5], out[5], (7, "another text of id 7"), (2**60, "far away")]


@pytest.fixture(scope="session")
def docs(spark, rows):
    schema = "doc_id long, text string, lang string, id string, row long, n long, score double, `key` binary, local int"
    return spark.createDataFrame([(*r, "en", "x", 1, 2, 0.5, b"k", 3) for r in rows], schema).repartition(5)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
