"""Column functions against small Python versions."""

import random
import re
import unicodedata

import pytest
from pyspark.sql import functions as F

from lectern.functions import text as T
from lectern.operators.align import ABOVE, CARRIER, graft, graft_all


def apply(spark, f, texts):
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, t string").select("i", f(F.col("t")).alias("o")).collect()
    return [r["o"] for r in sorted(rows)]


def test_simple_functions(spark):
    assert apply(spark, T.lower_between_hyphens, ["a-E-b-E-c", "E-a", "-E-E-", None]) == ["a-e-b-e-c", "E-a", "-e-e-", None]
    assert apply(spark, T.flatten_translit, ["âîûÂÎÛé"]) == ["aiuAIÛé"]
    assert apply(spark, T.squeeze_spaces, [" a  b  ", "\t\n x"]) == [" a b ", "\t\n x"]
    assert apply(spark, T.strip_lower, ["\x1c  Ab\x1f\n", " "]) == ["ab", ""]


def test_strip_is_pythons(spark):
    texts = [c + "x" + c for c in map(chr, [*range(0, 0x100), 0x1680, 0x180E, *range(0x2000, 0x2010), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000, 0xFEFF])]
    assert apply(spark, T.strip, texts) == [t.strip() for t in texts]


def test_guarded_word(spark):
    word, nukta = "खुदा", "ख़ुदा"
    out = T.GUARDED_REPLACEMENT
    assert apply(spark, T.replace_guarded, [word, f"({nukta})", word + "।", word + "ई", "अ" + word, "ख़ुदा", word + "ऽ"]) == [out, f"({out})", out + "।", word + "ई", "अ" + word, "ख़ुदा", out + "ऽ"]


def test_stacked_signs_against_a_loop(spark):
    """Within a run of characters that do not end a cluster, signs after a madd go."""
    rng = random.Random(5)
    letters = " xبـٰٱَٓۤۖۚۜیؕ"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randrange(14))) for _ in range(3000)]

    def cluster(run):
        start = re.search(f"[{T.MADD}]", run)
        return run if not start else run[: start.end()] + re.sub(f"[{T.SMALL_HIGH}]", "", run[start.end() :])

    inside = f"[{T.CLUSTER}{T.MADD}{T.SMALL_HIGH}]+"
    assert apply(spark, T.drop_stacked_signs, texts) == [re.sub(inside, lambda m: cluster(m[0]), t) for t in texts]


def test_code_points(spark):
    assert apply(spark, T.normalise_code_points, [" a​  b ", "لله", "بٓۚ", None]) == ["ٖa b", "للّٰه", "بٓ", None]


def test_flag_and_keys(spark):
    assert apply(spark, T.flag, ["", " 0 ", "none", "None", "false", "False", "0.0", "1", None]) == [0, 0, 0, 0, 0, 1, 1, 1, None]
    df = spark.createDataFrame([("2:255",), (" 7 : 1 ",)], "k string")
    chapter, verse = T.parse_key(F.col("k"))
    assert [tuple(r) for r in df.select(chapter, verse).collect()] == [(2, 255), (7, 1)]
    with pytest.raises(Exception, match="not a chapter:verse key"):
        spark.createDataFrame([("1:2:3",)], "k string").select(T.parse_key(F.col("k"))[0]).collect()


def test_graft(spark):
    plain, marked = "يَٰٓb", f"يَ{CARRIER}ٰٓb"
    assert graft_all([plain], [marked], True) == [(marked, 1)]
    assert graft_all(["يٰb"], [f"ي{CARRIER}ٰb"], True) == [("يٰb", 0)]
    assert graft_all(["يٰb"], [f"ي{CARRIER}ٰb"], False) == [(f"ي{CARRIER}ٰb", 1)]
    assert graft_all(["axb"], [f"a{CARRIER}b"], False) == [(f"ax{CARRIER}b", 1)]  # what stood there stays
    assert graft_all(["ab"], ["axb"], False) == [("ab", 0)] and graft_all([], [], False) == []
    df = spark.createDataFrame([(plain, marked), (None, "x"), ("", None)], "t string, r string").select(graft(F.col("t"), F.col("r")).alias("g")).select("g.*")
    assert [tuple(r) for r in df.collect()] == [(marked, 1), (None, 0), ("", 0)]
    assert unicodedata.combining(ABOVE)
