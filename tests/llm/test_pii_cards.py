"""Cards beside other numbers, each with its own pseudonym as if alone."""

from effort_analytics.llm import pseudonyms

CARD, AMEX, OTHER = "4111111111111111", "378282246310005", "5500000000000004"


def _out(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return [(r.text, r.pii_found) for r in sorted(pseudonyms.pseudonymise(df).collect(), key=lambda r: r.doc_id)]


def test_cards_beside_numbers(spark):
    (card, _), (amex, _), (other, _) = _out(spark, [CARD, AMEX, OTHER])
    assert len({CARD, AMEX, OTHER, card, amex, other}) == 6

    def spaced(x, sep=" "):
        return sep.join(x[i:i + 4] for i in range(0, 16, 4))
    a = f"{amex[:4]} {amex[4:10]} {amex[10:]}"
    cases = [(f"{spaced(CARD)} 123", f"{spaced(card)} 123", 1), (f"{CARD} 12/27", f"{card} 12/27", 1), (f"order 42 {CARD}", f"order 42 {card}", 1),
             (f"1234 5678 9012 {spaced(CARD)}", f"1234 5678 9012 {spaced(card)}", 1), (f"42 {CARD} {OTHER} 7", f"42 {card} {other} 7", 2),
             (f"{spaced(CARD, '-')} {spaced(OTHER, '-')}", f"{spaced(card, '-')} {spaced(other, '-')}", 2),
             ("no 17 3782 822463 10005 99", f"no 17 {a} 99", 1), (f"{CARD} 4111111111111112", f"{card} 4111111111111112", 1),
             ("1 2 3 4 5 6 7 8 9 1 2 3 4 5 6 7 8 9 1 2 3 4 5", "1 2 3 4 5 6 7 8 9 1 2 3 4 5 6 7 8 9 1 2 3 4 5", 0), ("4111 1111 1111 1112 12", "4111 1111 1111 1112 12", 0)]
    assert _out(spark, [t for t, _, _ in cases]) == [(t, n) for _, t, n in cases]


def test_card_before_other_kinds(spark):
    tails = ["2024-02-29", "555-123-4567", "123-45-6789", "10.0.0.1"]
    (card, _), *alone = _out(spark, [CARD, *tails])
    assert _out(spark, [f"{CARD} {t}" for t in tails]) == [(f"{card} {t}", 2) for t, _ in alone]
