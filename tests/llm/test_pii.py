import hashlib
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lowfold.llm import pii

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def plain(text):
    out = [(*m.span(), 0) for m in EMAIL.finditer(text)]
    out += [(*m.span(), 1) for m in IP.finditer(text) if all(int(x) <= 255 for x in m[0].split("."))]
    for m in CARD.finditer(text):
        digits = [int(c) for c in m[0] if c.isdigit()]
        doubled = [d if k % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d) for k, d in enumerate(reversed(digits))]
        if 12 <= len(digits) <= 19 and sum(doubled) % 10 == 0:
            out.append((*m.span(), 2))
    out += [(*m.span(), 3) for m in PHONE.finditer(text) if 9 <= sum(c.isdigit() for c in m[0]) <= 15]
    return sorted(out, key=lambda s: (s[0], s[2]))


@settings(max_examples=1500, deadline=None)
@given(st.text(alphabet="a@.-+1234567890 (%é", max_size=60))
def test_base_spans_are_those_of_the_patterns(text):
    assert pii.base_spans(text) == plain(text)


@pytest.mark.parametrize(
    ("text", "found"),
    [
        ("write john [at] example [dot] com now", ["email:john [at] example [dot] com"]),
        ("john.doe(at)mail(dot)example(dot)co(dot)uk", ["email:john.doe(at)mail(dot)example(dot)co(dot)uk"]),
        ("jоhn@exаmple.com hi", ["email:jоhn@exаmple.com"]),
        ("anna AT example DOT org", ["email:anna AT example DOT org"]),
        ("ip １９２.168.0.1 here", ["ip:１９２.168.0.1"]),
        ("four" + " one" * 15, ["card:four" + " one" * 15]),
        ("FOUR" + "-ONE" * 15 + "!", ["card:FOUR" + "-ONE" * 15]),
        ("look at the house, dot your eyes. meet at house.then we go", []),
        ("one two three people came at four", []),
        ("a@b.co and a [at] b [dot] co", ["email:a@b.co", "email:a [at] b [dot] co"]),
    ],
)
def test_disguises_map_back_to_the_source(text, found):
    assert [f"{pii.KINDS[k]}:{text[a:b]}" for a, b, k in pii.spans(text)[1]] == found


PIECES = ["john", "example", "com", "@", " ", "  ", "\n", ".", " at ", "[at]", "( AT )", "arroba", " dot ", "{dot}", "<.>", "Punkt", "poınt", "pun\u212at", "appointment", "é", "-", "7"]


@settings(max_examples=1500, deadline=None)
@given(st.lists(st.sampled_from(PIECES), max_size=14))
def test_addresses_are_found_whatever_else_the_text_holds(pieces):
    text = "".join(pieces)
    gated = pii.spans(text)
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(pii, "_HINT", re.compile(""))
        assert pii.spans(text) == gated


@pytest.mark.parametrize("address", ["john @ example.com", "john@ example.com", "john\n@example.com"])
@pytest.mark.parametrize("around", ["{}", "No sign. {}, or so", "an appointment. {}!"])
def test_white_space_beside_the_sign(address, around):
    text = around.format(address)
    assert [f"{pii.KINDS[k]}:{text[a:b]}" for a, b, k in pii.spans(text)[1]] == [f"email:{address}"]


@pytest.mark.parametrize(
    "number",
    [
        "ip:192[.]168[.]0[.]1", "ip:192 dot 168 dot 0 dot 1", "ip:192(DOT)168.0 Punkt 1", "ip:one nine two.one six eight.zero.one", "ip:one nine two dot 168 dot zero[.]one", "ip:１０ dot 0.0 dot one",
        "phone:+49 30 one two three 4567", "phone:+49 (30) one-two-three 4567", "phone:+four nine three zero one two three four five", "phone:+４９ 30 ONE two 3 4567",
        "card:four one one one 1111 1111 1111", "card:4111 1111 1111 one one one one", "card:4111-one one.one one-1111-1111",
    ],
)
@pytest.mark.parametrize("around", ["{}", "It is {}, or so, at one point.", "(see {})"])
def test_numbers_in_digits_words_and_signs(number, around):
    kind, number = number.split(":")
    assert f"{kind}:{number}" in [f"{pii.KINDS[k]}:{around.format(number)[a:b]}" for a, b, k in pii.spans(around.format(number))[1]]


@pytest.mark.parametrize("text", ["See 1. 2. 3. 4", "one. Two, three dot", "300 dot 1 dot 1 dot 1", "4111 1111 1111 one one one two", "anyone 5 dot 3", "at 12 one two", "7 \u017fix dot 5"])
def test_numbers_of_no_kind(text):
    assert pii.spans(text)[1] == []


@settings(max_examples=1000, deadline=None)
@given(st.lists(st.sampled_from([*PIECES, "one", "seven", "ＦＩＶＥ", "fünf", "\u017fix", "İ", "192", "4111", "+49", "+", ",", "(", ")", "\u200b"]), max_size=24))
def test_spans_are_in_order_and_apart(pieces):
    text = "".join(pieces)
    base, every = pii.spans(text)
    assert set(base) <= set(every) and every == sorted(every, key=lambda s: (s[0], s[2])) and all(0 <= a < b <= len(text) for a, b, _ in every)
    assert all(x[2] != y[2] or x[1] <= y[0] for x, y in zip(every, every[1:], strict=False))


def test_base_spans_stay_and_added_ones_do_not_overlap_them():
    text = "a@b.co 1.2.3.4 +49 30 1234567 4111 1111 1111 1111 x [at] y [dot] zz"
    base, every = pii.spans(text)
    assert base == plain(text) and set(base) <= set(every) and len(every) == len(base) + 1


@pytest.mark.parametrize("text", ["a" * 60_000, "1" * 40_000, "@" * 40_000, "a@" * 40_000, "four " * 40_000, " at " * 20_000, "(at)" * 20_000, "+1 " * 30_000, "a." * 30_000, "1." * 30_000])
def test_long_texts_take_linear_time(text):
    pii.spans(text)


def test_masking():
    assert pii.masked("mail a@b.co, call +49 30 1234567.") == "mail <EMAIL>, call <PHONE>."
    assert pii.masked("nothing here") == "nothing here" and pii.masked(None) is None and pii.masked("") == ""


def test_tables(odd_docs, no_docs):
    docs = odd_docs.limit(5).unionByName(odd_docs.sparkSession.createDataFrame([(90, "x a@b.co", None, None, 8, "s", "d", "x"), (91, None, None, None, None, None, None, None)], odd_docs.schema))
    out = {r.doc_id: r for r in pii.redacted(docs).collect()}
    assert pii.redacted(docs).columns == docs.columns
    assert (out[90].text, out[90].n_chars) == ("x <EMAIL>", 9) and out[91].text is None and out[91].n_chars is None
    found = {r.doc_id: r.f for r in docs.select("doc_id", pii.findings(docs.text).alias("f")).collect()}
    assert (found[90].n_email, found[90].spans, found[90].base_sha256) == (1, "email:2:8", hashlib.sha256(b"email:2:8").hexdigest())
    assert found[91].spans == "" and found[91].base_sha256 == hashlib.sha256(b"").hexdigest()
    assert pii.redacted(no_docs).count() == 0
