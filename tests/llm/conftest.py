import public_tokenizers
import pytest
from pyspark.sql import functions as F

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from (doc_id, text) pairs, over two partitions."""
    def make(rows, parts=2):
        rows = [(d, t, "en", "s", len(t) if t is not None else None) for d, t in rows]
        return spark.createDataFrame(rows, DOC_SCHEMA).repartition(parts)

    return make


@pytest.fixture(scope="session")
def with_clashes():
    """The table with extra columns named like the operators' own."""
    def add(df):
        return df.withColumns({c: F.lit(7) for c in (
            "part", "seq", "score", "n_tokens", "ids", "key", "n", "start", "length", "group",
            "round", "kept", "words", "node", "lines", "payload", "offset",
        )})

    return add


@pytest.fixture(scope="session")
def piece_path():
    return str(public_tokenizers.path("piece_bpe_32k.model"))


@pytest.fixture(scope="session")
def word_path():
    return str(public_tokenizers.path("word_bpe_49k.json"))


@pytest.fixture(scope="session")
def real_texts(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("text").collect()
    return [r.text for r in rows]


ODD_TEXTS = [
    None, "", " ", "a", "a  b", " a", "a ", "\n x\t", "　a", "ﬁ", "a▁b", "<s>x</s>", "\x00a \x00",
    "日本語語", "😀👍🏽 x", "  \n  \n", "ab" * 3000, "ééé" * 50, "▁▁a", " \t \t  x   y", "3.14 1,2",
    "<|endoftext|> x<|startoftext|>y", "don't I'LL ΑΣ Σ. ΣΣ", "a\x1cb\x85c d", "İstanbul é ́x Å.", "the, the. The!",
]
