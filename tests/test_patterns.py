"""The database's patterns, printed for Java: what they find, and what is no pattern."""

import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from biblioscope.functions.patterns import MOST, java_pattern
from biblioscope.functions.text import ci_match

# (pattern, texts in which it is found, texts in which it is not)
CASES = [
    # words and places
    (r"\mécole", ["une école", "École"], ["préécole"]),
    (r"^\w$", ["é", "ß", "中", "_", "7"], ["", "-", "éé"]),
    (r"\Métude|été\M", ["été", "d'été!"], ["étés"]),
    (r"\yété\y", ["l'été.", "été"], ["étés", "fété"]),
    (r"é\Yt", ["été"], ["é t"]),
    (r"\Y\Y", [" ", "ab"], []),
    ("[[:<:]]é[[:>:]]", ["à é !"], ["éa"]),
    (r"^\W$", ["-", " ", " "], ["é", "_"]),
    (r"^\D\S$", ["éé", "a-"], ["1a", "a ", "a "]),
    (r"^\d$", ["5", "٣"], ["a"]),
    (r"^\s$", [" ", "\n", " ", "　"], ["a", "_"]),
    (r"\AB", ["baa"], ["a\nb"]), (r"b\Z", ["ab"], ["b\n"]), ("b$", ["ab"], ["b\n", "b\na"]), ("^b", ["ba"], ["a\nb"]), ("a.b", ["a\nb", "a🙂b"], ["ab"]),
    # brackets
    ("^[[:alpha:]]+$", ["éÀß"], ["é1"]), ("^[[:upper:]]$", ["a", "É"], ["1"]), ("^[^[:alpha:]]$", ["1", " "], ["é"]), ("^[[:punct:]]$", ["!", "€", "§"], ["a"]),
    ("^[[:graph:]]$", ["a", "é", "!"], [" ", "\t"]), ("^[[:print:]]$", ["a", " "], ["\t", "\n"]), ("^[[:cntrl:]]$", ["\t"], ["a"]), ("^[[:blank:]]$", ["\t", " "], ["\n"]),
    ("^[[:xdigit:]]+$", ["fF09"], ["g"]), ("^[[:word:]]$", ["é", "_"], ["-"]), ("^[[:ascii:]]$", ["a"], ["é"]), ("^[^[:graph:]]$", [" "], ["a"]),
    ("^[]a]+$", ["]a"], ["b"]), ("^[^]a]$", ["b"], ["]", "a"]), ("^[a-]$", ["-"], ["b"]), ("^[-a]$", ["-", "A"], ["b"]), ("^[a&&b]$", ["&", "b"], ["c"]), ("^[a[]$", ["["], ["b"]),
    ("^[à-ý]$", ["é", "É"], ["e"]), (r"^[\d\-é]$", ["-", "É", "5"], ["a"]), (r"^[\D]$", ["a"], ["5"]), (r"^[^\W]$", ["é"], ["-"]), (r"^[^\wx-]$", ["!"], ["-", "é"]), (r"^[\]]$", ["]"], ["\\"]),
    ("^[[.a.]-[=c=]]$", ["b"], ["d"]), (r"^[\n\x41]$", ["\n", "a"], ["x"]), ("^[^x^]$", ["y"], ["^", "x"]), ("^[+--]$", [",", "-", "+"], ["."]), ("^[#/~]$", ["#"], ["a"]),
    # characters
    (r"^\x41$", ["a"], []), (r"^\x000000e9$", ["É"], []), (r"^é\U0001F642$", ["é🙂"], []), (r"^\101\0$", ["a\0"], []), (r"^\cA$", ["\x01"], []), (r"^\B$", ["\\"], []), (r"\.\*\é", [".*é"], ["aa"]),
    ("a{,5}", ["a{,5}"], ["aaaa"]), ("^{}$", ["{}"], []), ("^a]}$", ["a]}"], []), ("^a{x$", ["a{x"], []), (r"\e\a\b\t\v\f\r", ["\x1b\x07\x08\t\x0b\x0c\r"], []), ("^#a b$", ["#a b"], []), ("^/\"'&<>%~@$", ["/\"'&<>%~@"], []),
    # groups, bounds, alternatives
    ("^(a|bc){2}$", ["abc", "BCa"], ["a"]), ("^(?:ab)+?$", ["abab"], ["aba"]), (r"^(é)(x)\2\1$", ["éxxé", "éxXÉ"], ["éxéx"]), (r"^(a)\10$", ["a\x08"], ["a10"]), (r"^(a)(?:b)\1$", ["aba"], []),
    ("^a{2}$", ["aa"], ["a", "aaa"]), ("^a{2,}$", ["aaaa"], ["a"]), ("^a{1,3}?$", ["aaa"], ["aaaa"]), ("^a{0}$", [""], ["a"]), ("^(|a)b$", ["b", "ab"], ["aab"]), ("^()$", [""], ["a"]), ("a|", ["", "b"], []),
    ("^a|b$", ["ax", "xb"], ["xax"]), ("^é??$", ["", "é"], ["éé"]),
    # looking around
    ("é(?=t)", ["été"], ["éa"]), ("^é(?!t)", ["éa"], ["ét"]), ("(?<=é|tt)x", ["éx", "ttx"], ["tx"]), ("(?<!é{1,2})x$", ["ax", "x"], ["éx"]),
    # options in front, directors, comments
    ("(?c)É", ["École"], ["école"]), ("(?i)É", ["école"], []), ("(?n)a.b|^c$", ["a b", "x\nc\ny"], ["a\nb"]), ("(?p)a[^x]b|^c", ["a b"], ["a\nb", "x\nc"]), ("(?w)^a.b$", ["x\na\nb\ny"], ["ab"]),
    (r"(?n)^\W$", ["-"], ["\n"]), ("(?x) a b # to the end\n c [ ]", ["abc "], ["a b c "]), ("(?q)a.*(", ["xA.*(x"], ["ab"]), ("***=a+", ["a+"], ["aa"]), ("***:(?c)a", ["a"], ["A"]), ("a(?#not [this)b", ["ab"], []), ("(?t)a b", ["a b"], ["ab"]),
    (r"(?x)a\ b", ["a b"], ["ab"]), ("(?cs)a.", ["a\n"], ["A\n"]),
]

NONE = [
    "x++", "x**", "x*+", "x{2}{3}", "x+??", "*a", "+", "a|*b", "(*a)", "(?:+)", "^*", "$+", r"\y?", "(?=a)*", "a{1", "a{1,2x}", "a{3,2}", f"a{{{MOST + 1}}}", "a{1,999}",
    "(a", "a)", "[a", "[]", "[^]", "[[:nonsense:]]", "[[:alpha]", "[[.hyphen.]]", "[b-a]", "[a-c-e]", r"[a-\d]", r"[\y]", r"\q", "a\\", "[a\\", r"\1", r"(a\1)", r"(a)(?=\1)", r"\8", r"\x", r"\u12", r"\U00110000", r"\c",
    "(?<=a*)b", "(?<!é+|b)", r"(?<=[a]{2,})", "(?b)a", "(?e)a", "(?zi)a", "(?i", "a(?i)b", "(?<name>a)", "***a", "(?#",
]


def test_what_is_found(spark):
    pairs = [(p, text, True) for p, hits, _ in CASES for text in hits] + [(p, text, False) for p, _, misses in CASES for text in misses]
    patterns = {p: [i for i, x in enumerate(pairs) if x[0] == p] for p, _, _ in pairs}
    got = spark.range(1).select(*[F.array(*[ci_match(F.lit(pairs[i][1]), p) for i in own]) for p, own in patterns.items()]).first()
    wrong = [pairs[i][:2] for own, found in zip(patterns.values(), got, strict=True) for i, was in zip(own, found, strict=True) if was != pairs[i][2]]
    assert not wrong


@pytest.mark.parametrize("pattern", NONE)
def test_what_is_no_pattern(pattern):
    with pytest.raises(ValueError, match="at [0-9]+ of the pattern"):
        java_pattern(pattern)


def test_nulls(spark):
    nothing = F.lit(None).cast("string")
    assert spark.range(1).select(ci_match(nothing, "a"), ci_match(F.lit("a"), None), ~ci_match(nothing, "a")).first() == (None, None, None)


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from("ab.*+?{}[]()|^$\\1,-:=!<é \n#"), max_size=12))
def test_anything_is_a_pattern_or_a_value_error(pattern):
    try:
        java_pattern(pattern)
    except ValueError as error:
        assert re.search("at [0-9]+ of the pattern", str(error))
