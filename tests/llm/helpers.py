"""Small awkward tables for the text operators."""

CLASHING = ("digest string, n long, top long, fp long, low long, row string, kept string, score string, lang_pred string, "
            "component_id string, size string, id string, sha string, nth string, perplexity string, keep string")
LONG = "Ab cd, efg. " * 30_000


def awkward_docs(spark, rows):
    """``rows`` of (doc_id, text, lang) with more columns whose names clash with working columns."""
    names = [c.split()[0] for c in CLASHING.split(", ")]
    extra = tuple(None for _ in names)
    return spark.createDataFrame([(i, t, lang, "s", *extra) for i, t, lang in rows],
                                 "doc_id long, text string, lang string, source string, " + CLASHING)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)
