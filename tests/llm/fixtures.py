"""Small documents with every awkward case, and plain-Python versions of what operators should find."""

import random
import re

from pyspark.sql import types as T

#: Columns whose names clash with those the operators use inside.
CLASHING = ["row", "node", "grp", "token", "tokens", "key", "hash", "doc", "digest", "pos", "n", "item", "bin", "length", "words", "spans"]
SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
                       T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())])


def sentences(seed: int, n: int) -> str:
    draw = random.Random(seed)
    words = ["".join(draw.choice("abcdeéñ") for _ in range(draw.randint(1, 6))) for _ in range(40)]
    return " ".join(draw.choice(words) for _ in range(n))


def rows() -> list[tuple]:
    base, other = sentences(1, 120), sentences(2, 90)
    near = base.replace(base.split()[60], "changed", 1)
    passage = sentences(3, 30)
    texts = [base, base, near, other + " " + passage, passage + "\n" + sentences(4, 80), None, "", "   \n\t", "one", "one", "two words",
             "Ääh, ÖL! 123", "x" * 400, "#$% ||| ***\n#$% ||| ***", ("spam ham " * 70).strip(), "tail " + base[-200:], " a\x00b​ c "]
    out = [(i, t, ["en", "de", None][i % 3], ["src0", "src1", None][i % 3], len(t or "")) for i, t in enumerate(texts)]
    out.append(out[3])                              # a repeated row
    out.append((4, sentences(5, 70), "en", "src0", 1))   # a doc_id used twice
    out.append((None, base, "en", "src0", 1))
    out.append((None, None, None, None, None))
    return out


def documents(spark, clashing: bool = False, n: int | None = None):
    df = spark.createDataFrame(rows()[:n], SCHEMA)
    return df.selectExpr("*", *[f"'x' as {c}" for c in CLASHING]) if clashing else df


def words_of(text) -> list[str]:
    return re.findall("[^\x20\x09-\x0D]+", text or "")


def lowered(text) -> str:
    return (text or "").translate({i: i + 32 for i in range(65, 91)})
