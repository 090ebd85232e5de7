import pytest

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, component_id long, _part long"


def rows():
    """Nulls, empty and very long texts, ties, repeated rows, near copies."""
    body = " ".join(f"word{i}x{i * 7 % 13}" for i in range(120))
    near = body.replace("word60x", "other60x")
    out = [(i, f"The small unique text number {i} says things nobody else says at {i * i}.\nA line that repeats often\nshort",
            "en", "s0" if i % 3 else "s1", None) for i in range(10, 40)]
    out += [(1, None, None, None, None), (2, "", "en", "s0", 0), (3, "  \n\t ", "en", "s0", 5), (4, "!!! ... 123", "en", "s0", 11),
            (5, body, "en", "s0", None), (6, body, "en", "s1", None), (7, near, "en", "s2", None), (7, near, "en", "s2", None),
            (8, "x" * 30_000, "de", "s0", None), (9, "Ça été Σίσυφος İstanbul naïve\xa0text   end" * 50, "fr", "s0", None),
            (None, "A row without an id but with words in it", "en", "s0", None)]
    return [(*r, 99, 5) for r in out]


@pytest.fixture(scope="session")
def odd(spark):
    from finlake.llm.common import prepare
    return prepare(spark).createDataFrame(rows(), COLUMNS).repartition(3)


@pytest.fixture(scope="session")
def empty(odd):
    return odd.filter("false")
