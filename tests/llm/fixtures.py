"""Rows that every operator has to take: nulls, empty and long texts, ties, repeated rows, odd characters."""

ODD = [
    (0, "The quick brown fox  jumps over\nthe lazy dog. The quick brown fox jumps over the lazy dog again and again.", "en", "a.example"),
    (1, None, "en", "a.example"),
    (2, "", None, None),
    (3, " \n\t \r\n ", "fr", "b.example"),
    (4, "  leading and trailing  \n\n \n x", "en", None),
    (5, "<|endoftext|> in the text <|startoftext|>x</s><s> <unk>", "en", "a.example"),
    (6, "ΑΣ ΟΔΟΣ Σ İstanbul Straße ﬁ １２ é 漢字かな交じり文 Привет мир 👩‍👩‍👧  　x y ▁a▁▁b", "xx", "b.example"),
    (7, "word " * 3000 + "tail", "en", "a.example"),
    (8, "x" * 3000 + " it's we'll 12345 a1b2 ...!!! don't", "en", "a.example"),
    (9, "The quick brown fox  jumps over\nthe lazy dog. The quick brown fox jumps over the lazy dog again and again.", "en", "a.example"),
    (9, "The quick brown fox  jumps over\nthe lazy dog. The quick brown fox jumps over the lazy dog again and again.", "en", "a.example"),
    (10, "one two three", "de", "c.example"),
    (11, "\u0000\u0001\r\r\n;\r);\r\n{\r", "de", "c.example"),
]
SCHEMA = "doc_id long, text string, lang string, source string"


def odd_docs(spark, extra: bool = True):
    from pyspark.sql import functions as F

    df = spark.createDataFrame(ODD, SCHEMA).repartition(3)
    return df.withColumns({k: F.lit(1) for k in ("size", "bucket", "rank", "n", "words")} if extra else {})


def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


def sample_texts(n: int = 200):
    import pyarrow.parquet as pq

    return pq.read_table("/root/testdata/sf0.001/documents.parquet").to_pandas().text.tolist()[:n]
