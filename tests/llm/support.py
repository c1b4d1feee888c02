"""Small documents tables and table readers for the tests of tvlens.llm."""

import duckdb

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, score double, fingerprint string"
SF = "/root/testdata/sf0.001"


def docs(spark, texts, sources=None):
    """A documents table with extra columns whose names clash with results."""
    rows = []
    for i, t in enumerate(texts):
        doc_id, text = t if isinstance(t, tuple) else (i, t)
        source = sources[i] if sources else f"src{i % 3}"
        rows.append((doc_id, text, "en", source, len(text or ""), 0.5, "x"))
    return spark.createDataFrame(rows, DOCS)


def texts(sf=SF, columns="doc_id, text"):
    return duckdb.sql(f"SELECT {columns} FROM '{sf}/documents.parquet' ORDER BY doc_id").fetchall()


ODD = [
    None,
    "",
    "   ",
    "\n\n",
    "a",
    "one two",
    "x " * 30000,
    "no_space_" * 20000,
    "ein Wort  und  noch eins \t\n zum  Schluss ",
    "Ünïcödé 漢字かな交じり 🙂🙂 <|endoftext|> it's he'll <|endoftext|>",
    "\x00\x1c a\x1c b",
    "same text here, repeated",
    "same text here, repeated",
]
