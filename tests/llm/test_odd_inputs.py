"""Very long runs of digits, columns of the operators' own names, tables with nothing to learn from."""

import pytest

import corpus_pipeline as pipeline
from effort_analytics.llm import _common, mixing, pseudonyms, toxicity

CARD = "4111 1111 1111 1111"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def _docs(spark, texts):
    return spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in enumerate(texts)], DOCS)


def test_long_runs_of_digits(spark):
    texts = [CARD, "7" * 10**6, "1 " * 100_000, (CARD + " ") * 100_000, "12-" * 50_000, "a@b" + ".c" * 100_000 + " x", "+1" + "2" * 100_000, "1.1." * 50_000, "(555) " * 50_000]
    rows = {r.doc_id: r for r in pseudonyms.pseudonymise(_docs(spark, texts)).collect()}
    card = rows[0].text
    assert card != CARD and rows[3].text == (card + " ") * 100_000 and rows[3].pii_found == 100_000
    assert rows[1].text == texts[1] and rows[2].text == texts[2] and all(len(rows[i].text) == len(t) for i, t in enumerate(texts))


@pytest.mark.parametrize("lead", ["", "12 ", "1 2 3 "])
def test_cards_at_block_borders(spark, lead):
    """A card in every place of a long run, beside groups that make no card with it."""
    (card,) = [r.text for r in pseudonyms.pseudonymise(_docs(spark, [CARD])).collect()]
    texts = [lead + "1 " * n + CARD + " 1" * 9 for n in (0, 251, 252, 253, 254, 255, 256, 257, 600)]
    got = [r.text for r in sorted(pseudonyms.pseudonymise(_docs(spark, texts)).collect(), key=lambda r: r.doc_id)]
    assert got == [t.replace(CARD, card) for t in texts]


def test_clashing_columns(spark):
    rows = [(1, CARD, "en", "s", "p", "g", "x", 1.5, 7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, _pii string, _GAPS string, __pii string, _p double, _source int")
    got = pseudonyms.pseudonymise(docs).first()
    assert (got["_pii"], got["_GAPS"], got["__pii"], got["_p"], got["pii_found"]) == ("p", "g", "x", 1.5, 1)
    out = mixing.calibrated(docs).first()
    assert out["_p"] == 1.5 and out["_source"] == "s" and out["_pii"] == "p"


LABELS = "doc_id long, quality int, toxic int"


@pytest.mark.parametrize("labels", [[], [(1000 + i, 1, i % 2) for i in range(60)], [(i, 1, 0) for i in range(10)], [(0, 1, 1), (1, 1, 0)], [(None, 1, 1)]])
def test_toxicity_with_nothing_to_learn_from(spark, labels):
    marks = spark.createDataFrame(labels, LABELS)
    for docs in (_docs(spark, ["some words", "", None, "you idiot", "a", "b", "c", "d", "e", "f"]), _docs(spark, [])):
        rows = toxicity.score_documents(docs, marks).collect()
        assert len(rows) == docs.count() and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)


def test_toxicity_stage_of_an_empty_table(spark, tmp_path):
    spark.createDataFrame([(i, 1, i % 2) for i in range(40)], LABELS).write.parquet(f"{tmp_path}/labels.parquet")
    assert pipeline.clean(spark, _docs(spark, []), str(tmp_path)).count() == 0


def test_shared_folder_is_no_local_one_on_a_cluster():
    class Session:
        class conf:
            get = staticmethod(lambda *_: None)

        class sparkContext:
            master = "spark://host:7077"

            class _jsc:
                sc = staticmethod(lambda: type("S", (), {"getCheckpointDir": staticmethod(lambda: type("O", (), {"isDefined": staticmethod(lambda: False)})())})())

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        _common.shared_dir(Session)
