"""Broken pages take time in proportion to their length; exception phrases reach over any blanks."""

import random
import time

import pytest

from beatline.llm import html_text as ht
from beatline.llm.toxicity import ToxicityModel


@pytest.mark.parametrize("unit", ["<a", "<a href='x ", "<a b ", "<span></b>", "<span>", "<b><div><span></b>", "<!--", "<ul><div><li></li>",
                                  "<a b='", "\"<a", "<p><p>", "<x a=\"'\" ", "</b>", "<![CDATA[", "<td><li>", "&amp", "<script"])
def test_a_megabyte_of_broken_markup(unit):
    page = unit * (1_000_000 // len(unit))
    began = time.perf_counter()
    ht.parse(page)
    assert time.perf_counter() - began < 20            # about 3 s at most on a free machine


def plain(page):
    """(start, end) of every token by one look at each '<', however long that takes."""
    out, at = [], 0
    while (start := page.find("<", at)) >= 0:
        at, rest = start + 1, page[start + 1:]
        end = None
        if rest.startswith(("!--", "![CDATA[")):
            mark, skip = ("-->", 3) if rest.startswith("!--") else ("]]>", 8)
            end = page.find(mark, at + skip)
            end = len(page) if end < 0 else end + 3
        elif rest[:1] in ("!", "?") and rest:
            end = page.find(">", at + 1) + 1 or None
        elif rest[:2].lstrip("/")[:1].isalpha() and (rest[0].isalpha() or rest[0] == "/") and rest.lstrip("/")[:1].isascii():
            name = at + (rest[0] == "/")
            while name < len(page) and not page[name].isspace() and page[name] not in "/>":
                name += 1
            k = name
            while k < len(page) and page[k] != ">":
                if page[k] in "\"'":
                    closing = page.find(page[k], k + 1)
                    if closing < 0:
                        break
                    k = closing
                k += 1
            end = k + 1 if page[k:k + 1] == ">" else page.find(">", name) + 1 or None
        if end:
            out.append((start, end))
            at = end
    return out


def test_tokens_equal_a_plain_scan():
    rng = random.Random(8)
    parts = ["<p>", "</p>", "<b x=\"y>z\">", "<a href='x ", "<a b ", "'", "\"", ">", "<", "<!-- c -->", "<!--", "-->", "<![CDATA[x]]>",
             "<!doctype html>", "<?pi?>", "text ", "<br/>", "<p", "</", "<a/b>", "<a\"b>", "< 5", "<1>", "=", "/"]
    for _ in range(20_000):
        page = "".join(rng.choice(parts) for _ in range(rng.randrange(1, 14)))
        assert [t[:2] for t in ht.Scanner(page).tokens()] == plain(page), page


def test_exception_phrases_reach_over_any_blanks():
    model = ToxicityModel({" fool ": 4.0}, frozenset({" fool proof ", " no one is a fool here "}))
    for blanks in (1, 3, 250, 5000):
        assert not model.matches("a fool" + " " * blanks + "proof")
        assert not model.matches((" " * blanks).join("no one is a fool here".split()))
        assert model.matches("a fool" + " " * blanks + "indeed") and model.matches("one is a fool" + " " * blanks + "here")
    words = ("fool proof " * 20_000) + "fool"
    began = time.perf_counter()
    assert len(model.matches(words)) == 1 and time.perf_counter() - began < 20
