import hashlib
import random
import re
import time

import pytest

from cartwheel.llm import pii


def brute(t):
    """The contract's base patterns, one regular expression each."""
    t = t or ""
    out = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t):
        if all(int(p) <= 255 for p in m[0].split(".")):
            out.append((m.start(), 1, m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        d = [int(c) for c in m[0] if c.isdigit()]
        total = sum(x if k % 2 == 0 else (2 * x if x < 5 else 2 * x - 9) for k, x in enumerate(reversed(d)))
        if 12 <= len(d) <= 19 and total % 10 == 0:
            out.append((m.start(), 2, m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t):
        if 9 <= sum(c.isdigit() for c in m[0]) <= 15:
            out.append((m.start(), 3, m.end()))
    return sorted(out)


def test_base_spans_of_random_texts():
    rng = random.Random(1)
    pieces = ["a", "Z", "9", "0", "1", "25", ".", "..", "@", "-", "+", " ", "(", ")", "%", "_", "é", "\n", "a@b.c", "1.2.3.4", "+1 (269) 555-3296",
              "4539 1488 0343 6467", "4539148803436467", "255", "256", "x"]
    for _ in range(4000):
        t = "".join(rng.choice(pieces) for _ in range(rng.randint(0, 25)))
        assert pii.detect(t) == brute(t), t


@pytest.mark.parametrize("t,kinds", [
    ("mail joe.doe [at] mail7 (dot) example dot com now", [("email", "joe.doe [at] mail7 (dot) example dot com")]),
    ("jane at example dot org.", [("email", "jane at example dot org")]),
    ("user{at}site[.]co", [("email", "user{at}site[.]co")]),
    ("ｊｏｅ@ｍａｉｌ.ｃｏｍ", [("email", "ｊｏｅ@ｍａｉｌ.ｃｏｍ")]),
    ("jоe@mail.com", [("email", "jоe@mail.com"), ("email", "e@mail.com")]),
    ("jo\u200be@mail.com", [("email", "jo\u200be@mail.com"), ("email", "e@mail.com")]),
    ("call plus one two six nine five five five three two nine six please", [("phone", "plus one two six nine five five five three two nine six")]),
    ("four five three nine 1488 0343 6467 x", [("card", "four five three nine 1488 0343 6467")]),
    ("at 192 dot 168 dot 1 dot 1!", [("ip", "192 dot 168 dot 1 dot 1")]),
    ("٤٥٣٩١٤٨٨٠٣٤٣٦٤٦٧", [("card", "٤٥٣٩١٤٨٨٠٣٤٣٦٤٦٧")]),
    ("We met at the dot com office at one or two.", []),
    ("un un un un un un un un un un un un un un un un", []),
    ("one two three four", []),
])
def test_disguises(t, kinds):
    base, every = pii.spans_of(t)
    assert sorted((pii.KINDS[k], t[a:b]) for a, k, b in every) == sorted(kinds)
    assert base == brute(t) and set(base) <= set(every)


@pytest.mark.parametrize("t,kind", [
    ("user［at］example.com", "email"),
    ("joe at example dоt com", "email"),
    ("joe at example d\u200bot com", "email"),
    ("ｆｏｕｒ ｆｉｖｅ ｔｈｒｅｅ ｎｉｎｅ ｏｎｅ ｆｏｕｒ ｅｉｇｈｔ ｅｉｇｈｔ ｚｅｒｏ ｔｈｒｅｅ ｆｏｕｒ ｔｈｒｅｅ ｓｉｘ ｆｏｕｒ ｓｉｘ ｓｅｖｅｎ", "card"),
    *[("".join(chr(zero + int(d)) for d in "4539148803436467"), "card") for zero in (0x9E6, 0xE50, 0xBE6, 0x17E0, 0x104A0)],
])
def test_disguised_triggers_and_all_digits(t, kind):
    base, every = pii.spans_of(t)
    assert (0, pii.KINDS.index(kind), len(t)) in every
    assert base == brute(t)


@pytest.mark.parametrize("before,number,after,kind", [
    ("pay ", "four" + " one" * 15, " now", "card"),
    ("pay ", "five " * 12 + "four four four four", " now", "card"),
    ("call ", "+1 269 555 three two nine 6", " now", "phone"),
    ("pay ", "4539 1488 0343 six four 67", " now", "card"),
    ("pay ", "4539 1488 0343 646 seven", " now", "card"),
    ("pay ", "4111 one one one one 1111 1111", " now", "card"),
    ("no one ", "4539 1488 0343 six four 67", " now", "card"),
    ("pay ", "four five three nine 1488 0343 6467", " one of them", "card"),
    ("at ", "192 dot 168 dot one dot 7", "!", "ip"),
    ("at ", "192 dot 168 dot 1 dot 7", " one day", "ip"),
])
def test_short_and_partly_spelled_runs(before, number, after, kind):
    base, every = pii.spans_of(before + number + after)
    assert not base and (len(before), pii.KINDS.index(kind), len(before + number)) in every


@pytest.mark.parametrize("t,span,kind", [
    ("agent seven one at example dot com", "seven one at example dot com", "email"),
    ("juan arroba ejemplo punto com", "juan arroba ejemplo punto com", "email"),
    ("écrire à jean arobase exemple point fr.", "jean arobase exemple point fr", "email"),
    ("hans klammeraffe beispiel punkt de", "hans klammeraffe beispiel punkt de", "email"),
    ("mail bob @ example . com now", "bob @ example . com", "email"),
    ("mail bob @ example.com now", "bob @ example.com", "email"),
    ("call +1 212 555 double zero one two", "+1 212 555 double zero one two", "phone"),
    ("call plus one two one two triple five double zero one two", "plus one two one two triple five double zero one two", "phone"),
    ("user﹫example．com", "user﹫example．com", "email"),
    ("user@example。com", "user@example。com", "email"),
    ("4539\u00a01488\u00a00343\u00a06467", "4539\u00a01488\u00a00343\u00a06467", "card"),
    ("4539\u20111488\u20110343\u20116467", "4539\u20111488\u20110343\u20116467", "card"),
    ("to joe (\u3000at ) site [ dot ] org", "joe (\u3000at ) site [ dot ] org", "email"),
])
def test_further_disguises(t, span, kind):
    base, every = pii.spans_of(t)
    assert [(pii.KINDS[k], t[a:b]) for a, k, b in every if (a, k, b) not in base] == [(kind, span)]
    assert base == brute(t)


@pytest.mark.parametrize("t", [
    "see you at noon dot the end", "arrive at boiling point it is", "we met @ noon. It was late", "look at this point we know",
    "meet at five dot tomorrow", "am Punkt", "el punto de vista", "look at example com", "un punto", "double trouble at one"])
def test_prose_is_left_alone(t):
    assert pii.spans_of(t) == ([], [])


def naive_copy(t):
    """The bracket and bare rewrites of an ASCII text, one character at a time, each with its source places."""
    out, k = [], 0
    marks = {"[at]": "@", "(at)": "@", "{at}": "@", "[dot]": ".", "(dot)": ".", "[.]": ".", "<@>": "@"}
    while k < len(t):
        j = k
        while j < len(t) and t[j].isspace():
            j += 1
        mark = next((m for m in marks if t.startswith(m, j)), None)
        if mark:
            e = j + len(mark)
            while e < len(t) and t[e].isspace():
                e += 1
            out.append((marks[mark], k, e))
            k = e
        else:
            out += [(t[x], x, x + 1) for x in range(k, max(j, k + 1))]
            k = max(j, k + 1)
    return out


def test_added_spans_of_bracketed_texts():
    """Against a plain rewrite and the contract's own patterns."""
    rng = random.Random(8)
    pieces = ["a", "b.c", "x1", "[at]", "(at)", "{at}", "[dot]", "(dot)", "[.]", "<@>", " ", "  ", "\n", ".", "-", "com", "7", "1.2", "@"]
    for _ in range(4000):
        t = "".join(rng.choice(pieces) for _ in range(rng.randint(0, 18)))
        base = brute(t)
        copy = naive_copy(t)
        added = set()
        for a, k, b in brute("".join(c for c, _, _ in copy)):
            start, end = copy[a][1], copy[b - 1][2]
            if not any(k == k2 and a2 <= start and end <= b2 for a2, k2, b2 in base):
                added.add((start, k, end))
        if any(" @" in x or "@ " in x or " . " in x for x in (t, "".join(c for c, _, _ in copy))):
            continue  # signs with spaces around them are another transducer's
        assert pii.spans_of(t) == (base, sorted([*base, *added])), t


@pytest.mark.parametrize("t", ["zero " * 16, "un un un six", "five one at the door", "plus" + " un" * 10, "one, two, three and four"])
def test_number_words_in_prose(t):
    assert pii.spans_of(t) == ([], [])


def test_edge_cases(spark, edge, rows):
    got = pii.find(edge).collect()
    assert len(got) == len(rows)
    want = []
    for i, t in rows:
        b = brute(t)
        digest = hashlib.sha256(",".join(f"{pii.KINDS[k]}:{x}:{y}" for x, k, y in b).encode()).hexdigest()
        want.append((i, *(sum(s[1] == k for s in b) for k in range(4)), digest))
    assert sorted((tuple(r)[:6] for r in got), key=repr) == sorted(want, key=repr)
    out = pii.redacted(edge)
    assert out.columns == edge.columns and out.count() == len(rows)


def test_query_base_spans(spark, documents):
    texts = {r.doc_id: r.text for r in documents.collect()}
    for r in pii.find(documents).collect():
        b = brute(texts[r.doc_id])
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s[1] == k for s in b) for k in range(4)]
        assert r.base_sha256 == hashlib.sha256(pii.as_text(b).encode()).hexdigest()
        assert set(pii.as_text(b).split(",")) <= set(r.spans.split(","))


def test_empty_table(empty):
    assert pii.find(empty).count() == 0


def test_redaction():
    assert pii.redact("to a@b.co and jane (at) x.org.") == "to <email> and <email>."
    assert pii.redact(None) is None and pii.redact("") == ""


@pytest.mark.parametrize("piece", ["a", "1", "1.", "@a", "a.", "+1", "1 ", "one ", "[at]", " dot ", "(", "a@", "- ", "é", " ", "\n", "\t", "( ", " at ", "@ ", " . ", "a at b ", "one  "])
def test_long_texts_take_linear_time(piece):
    t = piece * (400_000 // len(piece))
    began = time.process_time()
    pii.spans_of(t)
    assert time.process_time() - began < 10


@pytest.mark.parametrize("blank", [" ", "\n", "\t", "\u00a0"])
@pytest.mark.parametrize("before", ["(", " dot ", "a at ", "a@", "joe at x", "one ", "[at] ", "arroba x punto", "1 ", "a @"])
def test_a_megabyte_of_blanks(before, blank):
    t = before + blank * 1_000_000 + " dot (x"
    began = time.process_time()
    pii.spans_of(t)
    assert time.process_time() - began < 10
