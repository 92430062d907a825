"""Small tables with awkward rows, and plain versions of what the operators compute."""
import random
import re

from pyspark.sql import functions as F

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
AWKWARD = [None, "", " ", "\n\n", "a", "A a A", "one two three four", "Ünïcode ß Σ ΑΣ İ ﬁ ²ª × 中文 🙂 é \x1c\x85　x",
           "<|endoftext|> a<|startoftext|>b <|ENDOFTEXT|>", "don't we'll I'M 'S 1234 x9y", "a\tb  c \n d \r\n e", "\0 nul \0",
           "!!! ??? ...", "z" * 5000, "word " * 4000, "    y"]


def ascii_lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def words_of(text):
    return WORDS.findall(ascii_lower(text or ""))


def frame(spark, rows, columns="doc_id long, text string"):
    """Rows with extra columns whose names the operators use themselves."""
    df = spark.createDataFrame(rows, columns)
    clash = ["words", "h", "key", "component", "query", "n", "fp", "pos", "band", "score", "ids", "y", "sha1", "first"]
    return df.select("*", *[F.lit(1).alias(c) for c in clash if c not in df.columns])


def awkward(spark):
    """Every awkward text, one row twice, one without an id."""
    rows = [(i, t) for i, t in enumerate(AWKWARD)]
    return frame(spark, rows + [rows[9], (None, "no id here")])


def prose(seed, n, vocabulary=400):
    r = random.Random(seed)
    return [f"w{r.randrange(vocabulary)}" for _ in range(n)]
