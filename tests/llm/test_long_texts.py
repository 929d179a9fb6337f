"""Time in proportion to the length of a text, and the faster forms against plain ones."""

import random
import time

import pytest

from goldseam.llm import htmltext, licences, secrets

SIZE = 400_000


def seconds(fn, text):
    start = time.perf_counter()
    fn(text)
    return time.perf_counter() - start


@pytest.mark.parametrize(
    "part", ["<div>", "<div>a, b", "<b>", "<b>x", "<p><b>", "<div><p>text, here</p>", "<li><div>", "<i><div>", "<td><b>"]
)
def test_deep_pages(part):
    n = SIZE // len(part)
    assert seconds(htmltext.main_text, part * n) < 8
    for tail in ("</i>", "<p></p>", "<li></li>", "</div>"):
        assert seconds(htmltext.main_text, part * (n // 2) + tail * (SIZE // 2 // len(tail))) < 8


def test_long_attributes_and_references():
    assert seconds(htmltext.main_text, "<p " + "a" * SIZE + ">x") < 4
    assert htmltext.main_text("<p>a &#" + "9" * SIZE + "; &#" + "0" * SIZE + "65; b</p>") == "a � A b"
    assert htmltext.unescape("&#65;&#x41;&#0;&#1114112;&amp;") == "AA��&"


class Walking(htmltext.OpenElements):
    """The same rules by walking the stack from its end."""

    def close(self, tag):
        for place in range(len(self.nodes) - 1, 0, -1):
            if self.names[place] == tag:
                return self.cut(place)
            if tag in htmltext.INLINE and self.names[place] not in htmltext.INLINE:
                return None

    def make_room(self, tag):
        ended, borders = htmltext.ENDS.get(tag, (set(), set()))
        for place in range(len(self.nodes) - 1, 0, -1):
            name = self.names[place]
            if name == "p" or name in ended:
                self.cut(place)
                if not ended or name != "p":
                    return
            elif name in borders or (name not in htmltext.INLINE and not ended):
                return


def test_tree_by_places(monkeypatch):
    rng = random.Random(5)
    tags = "p div b i a li ul td tr table dt dd dl option select article section header br h2 span".split()
    pages = [
        "".join(rng.choice(("<%s>", "</%s>", "<%s/>")) % rng.choice(tags) + rng.choice(("", "word. ")) for _ in range(40))
        for _ in range(2000)
    ]
    got = [htmltext.Page(p) for p in pages]
    monkeypatch.setattr(htmltext, "OpenElements", Walking)
    for page, fast in zip(pages, got):
        plain = htmltext.Page(page)
        assert (plain.tags, plain.parents, plain.events) == (fast.tags, fast.parents, fast.events)


@pytest.mark.parametrize("part", ["auth", "auth ", "token=abcdefgh ", "AKIA", "kJ8f2LmQx93ZbVtauth", "0123456789abcdef01234567 token "])
def test_secrets_in_long_lines(part):
    def scan(text):
        return secrets.novel_spans(text, secrets.base_spans(text))

    assert seconds(scan, "x = " + part * (SIZE // len(part))) < 8


def test_secret_between_many_words():
    key = "kJ8f2LmQx93ZbVt7Yw0RsPd4"
    for text in (f"auth_token_{key}", f"{key}_auth_token", f"token_auth_{key}_secret_token", f"token: {key}", f"{key} is the token"):
        found = secrets.novel_spans(text, [])
        assert len(found) == 1 and key in text[found[0][0] : found[0][2]], text
    assert secrets.novel_spans(f"{key} {'x ' * 40} token", []) == []
    # What a base span covers is not reported again, whichever base span it is.
    text = f"token={key} token={key[::-1]}"
    assert len(secrets.base_spans(text)) == 2 and secrets.novel_spans(text, secrets.base_spans(text)) == []


def test_licences_in_long_lines(spark):
    n = 200_000
    name = licences.SENTENCES[14]
    texts = ["license" + " " * n + "x", "license " + "(" * n + "x", "license " + "()" * (n // 2) + "x", ". " * (n // 2) + "license",
             "copyright. " * (n // 10), "license. " * (n // 9), " " * n + "license", "(c) " * (n // 4)]
    rows = [(i, t + "\n\n" + name) for i, t in enumerate(texts)] + [(99, name)]
    df = spark.createDataFrame(rows, "i int, text string")
    start = time.perf_counter()
    got = {r.i: r["_licences"] for r in licences.find_licences(df).collect()}
    assert time.perf_counter() - start < 40
    assert got[99] and all(v == got[99] for v in got.values())
