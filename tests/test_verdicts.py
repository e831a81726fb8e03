import pytest
from pyspark.sql import functions as F

from duelboard.functions import verdicts as V


def test_labels(evaluate):
    cases = {
        "[[A>>B]] then [[b=a]]": "B=A",
        "[[]] [A>B]": "A>B",
        "[A]": "A",
        "nothing": None,
        "reason [[A>B]]": "A>B",
        "reason [A<B]": "A<B",
        "analysis without label": None,
        "": None,
    }
    assert evaluate(V.parse_label, list(cases)) == list(cases.values())


def test_patterns_with_two_groups_are_refused():
    with pytest.raises(ValueError):
        V.parse_label(F.lit("x"), (r"(a)(b)",))


def test_label_codes_cover_the_table(evaluate):
    from duelboard import constants as K

    labels = [*K.LABEL_SCORES, "junk", None]
    for score in (0.0, 0.5, 1.0):
        want = [w if s == score else 0 for s, w in K.LABEL_SCORES.values()] + [0, 0]
        assert evaluate(lambda c: V.code_votes(V.label_code(c), score), labels) == want


REPLIES = {
    'Comparison: x\nWinner: "b"': ("x", "B"),
    "Neither is a clear choice": (None, "A"),
    '{"winner":"TIE","comparison":"same"}': ("same", "TIE"),
    '{"Winner": "c", "Comparison": " y "}': ("y", "C"),
    '{"comparison": "", "Comparison": "z", "winner": 3}': ("z", None),
    "Winner: A\nwinner: c": (None, "C"),
    "Winner: A\nWinner: nobody": (None, "A"),
    '{"winner": "B", broken': (None, "B"),
    "  ": (None, None),
    "no choice here": (None, None),
    "été à côté": (None, None),
    "COMPARISON:  first \nline\nComparison: second": ("second", None),
    "x\x0bWinner: TIE": (None, "TIE"),
}


def test_comparison_replies(evaluate):
    got = evaluate(V.parse_comparison, list(REPLIES))
    assert [(r["comparison"], r["winner"]) for r in got] == list(REPLIES.values())


def test_unknown_positions_are_ties(evaluate):
    labels = F.create_map(F.lit("A"), F.lit("x"), F.lit("B"), F.lit("y"))
    got = evaluate(lambda c: V.settle_winner(c, labels), ["A", "B", "C", "TIE", None])
    assert [(r["winner"], r["winner_key"]) for r in got] == [
        ("A", "x"), ("B", "y"), ("TIE", "TIE"), ("TIE", "TIE"), ("TIE", "TIE"),
    ]
