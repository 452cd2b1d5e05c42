"""The keyword prefilter against the rules without it, on the title of every rule with any white space."""

import re

import pytest

from effort_analytics.llm import license_scan

try:  # Python 3.11 on
    from re import _parser
except ImportError:
    import sre_parse as _parser


def _examples(tree, space):
    """Texts that the parsed pattern matches: each alternative at least once, optional parts left out and put in."""
    out = [""]
    for op, arg in tree:
        op = str(op)
        if op == "LITERAL":
            parts = [chr(arg)]
        elif op == "IN":
            first = str(arg[0][0]), arg[0][1]
            parts = [space] if ("CATEGORY" in first[0] and "SPACE" in str(first[1])) or (first[0] == "LITERAL" and chr(first[1]) == " ") else \
                [chr(first[1])] if first[0] == "LITERAL" else [chr(first[1][0])] if first[0] == "RANGE" else ["x"] if first[0] == "CATEGORY" and "DIGIT" not in str(first[1]) else ["1"]
        elif op in ("MAX_REPEAT", "MIN_REPEAT"):
            low, _, sub = arg
            inner = _examples(sub, space)
            parts = inner if low else ["", *inner]
        elif op == "SUBPATTERN":
            parts = _examples(arg[3], space)
        elif op == "BRANCH":
            parts = [x for b in arg[1] for x in _examples(b, space)]
        elif op in ("AT", "ASSERT", "ASSERT_NOT"):
            parts = [""]
        else:
            raise AssertionError(op)
        out = [a + b for a in out for b in parts][:300]
    return out


@pytest.mark.parametrize("space", [" ", "\n", "  ", " \n\t"])
def test_prefilter_loses_no_title(space):
    rules, matched = license_scan.compiled(), set()
    for n, (rule, keys, pattern) in enumerate(rules):
        if rule.form != "title":
            continue
        for text in _examples(_parser.parse(rule.pattern), space):
            text = text.encode()
            if pattern.search(text):
                matched.add(n)
                assert all(any(k in text for k in alike) for alike in keys), (rule.label, text)
    assert len(matched) == sum(r.form == "title" for r, _, _ in rules)


@pytest.mark.parametrize("text, label", [("mit no\nattribution", "mit-0"), ("common  public\nattribution license", "cpal-1"),
                                         ("open\ndata commons attribution license", "odc-by"), ("responsible\n ai license", "openrail"),
                                         ("do what\nthe f*ck you want to public license", "wtfpl")])
def test_wrapped_titles(text, label):
    assert label in {r.label for _, _, r in license_scan.detections(text.encode(), license_scan.compiled())}
    assert re.search(r"\s", text)
