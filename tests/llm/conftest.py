import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long, "
#: Extra columns whose names the operators use inside, or give to their results.
EXTRA = "_words _spans _tokens _probability _kept _source _lang _topic _drop gone score lang_pred rejected row words spans n comp id rep key token draw component_id kept".split()


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from (id, text) or (id, text, lang, source), with extra columns."""

    def make(rows):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else "s", None if r[1] is None else len(r[1]), *(f"{c}-{r[0]}" for c in EXTRA)) for r in rows]
        return spark.createDataFrame(full, DOCS + ", ".join(f"`{c}` string" for c in EXTRA))

    return make


@pytest.fixture(scope="session")
def unchanged():
    """Asserts that the rows of a table are rows of docs, every value of every column, ``but`` some columns."""

    def same(out, docs, but=()):
        assert out.columns == docs.columns
        names = [c for c in docs.columns if c not in but]
        have = {str(tuple(r)) for r in docs.select(*names).collect()}
        rows = [str(tuple(r)) for r in out.select(*names).collect()]
        assert rows and set(rows) <= have
        return rows

    return same
