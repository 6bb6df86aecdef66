import pytest

WORDS = "the of and to in that is was for on with as his they at be this from have or by one had not but what all were when we there can an your which their said if do will each about how up out them then she many some so these would other into has more her two like him see time could no make than first been its who now people my made over did down only way find use may water long little very after words called just where most know".split()


def prose(n, seed):
    return " ".join(WORDS[(i * i * 7 + seed * 31 + i * seed) % len(WORDS)] + ("." if i % 11 == 10 else "") for i in range(n))


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, empty and long texts, ties and repeated rows, and columns whose names operators use themselves."""
    rows = [
        (1, prose(60, 1), "en", "a", 5), (2, prose(60, 1), "en", "a", 5), (3, None, None, None, None), (4, "", "en", "b", 0), (5, " \t\n", "en", "b", 3),
        (6, "one", "de", None, 3), (7, "two words", "de", "é", 9), (8, prose(30_000, 2), "en", "a", 1), (9, prose(45, 3) + "\n" + prose(45, 3), "fr", "a", 1),
        (10, "Ünïcödé ß ﬁ ԱԲԳ 漢字 🌾 it's we'RE x y " + prose(25, 4), "es", "c", 1), (10, "Ünïcödé ß ﬁ ԱԲԳ 漢字 🌾 it's we'RE x y " + prose(25, 4), "es", "c", 1),
        (10, "another text of the same id", "es", "c", 1), (None, prose(40, 1), "en", "z", 1), (11, "x" * 70_000, None, "a", 1), (12, "### $$$ %%% &&& *** !!! ###", "en", "a", 1),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    clash = {"_id": "i", "_rest": "r", "_text": "t", "ids": "x", "score": "s", "kept": "k", "size": "z", "block": "b", "fp": "f", "_tie": "e", "component_id": "c", "target": "g", "predicted": "p"}
    from pyspark.sql import functions as F

    return df.withColumns({k: F.lit(v) for k, v in clash.items()}).repartition(3).cache()
