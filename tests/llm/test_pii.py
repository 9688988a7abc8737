import random
import re

import pytest

from panelwise.llm import pii as I
from panelwise.llm import queries as Q

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(d):
    total = 0
    for n, c in enumerate(d[::-1]):
        x = int(c) * (2 if n % 2 else 1)
        total += x if x < 10 else x - 9
    return total % 10 == 0


def plain(text):
    out = [(m.start(), 0, m.end()) for m in EMAIL.finditer(text)]
    out += [(m.start(), 1, m.end()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]
    for m in CARD.finditer(text):
        d = re.sub("[^0-9]", "", m[0])
        if 12 <= len(d) <= 19 and luhn(d):
            out.append((m.start(), 2, m.end()))
    out += [(m.start(), 3, m.end()) for m in PHONE.finditer(text) if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    return ",".join(f"{I.KINDS[k]}:{a}:{b}" for a, k, b in sorted(out))


def test_rules_on_random_strings():
    r = random.Random(1)
    pieces = ["a", "B", "@", "@", ".", ".", "-", "+", "+1", " ", "1", "23", "255", "256", "4111111111111111", "4111 1111-1111 1111", "(555) 010-9999", "mail.example.com", "bob@x.org", "10.0.0.1", "é", "\n", "%"]
    for _ in range(20_000):
        text = "".join(r.choice(pieces) for _ in range(r.randint(0, 14)))
        assert I.joined(I.base_spans(text)) == plain(text), text


def test_long_words_take_linear_time():
    for text in ("a" * 2_000_000 + "@", "1" * 300_000, "+1" + "(" * 300_000, "a@" * 200_000, "1." * 200_000, "x@" + "a" * 300_000):
        I.base_spans(text)


@pytest.fixture(scope="module")
def contact_rows(odd_rows, words):
    r = random.Random(2)
    w = lambda: " ".join(r.choice(words) for _ in range(8))
    rows = list(odd_rows)
    rows += [(1000 + i, f"{w()} please ring us at +1 (555) 010-{1000 + i} or {w()}") for i in range(40)]
    rows += [(2000 + i, f"{w()} please ring us at 010-77{100 + i} or {w()}") for i in range(3)]  # no rule knows these
    rows += [(3000 + i, f"{w()} version {10000 + i} {w()}") for i in range(40)]
    return rows


def test_contexts_find_what_no_rule_knows(documents, contact_rows):
    got = I.find_personal_data(documents(contact_rows, clashing=True)).collect()
    assert len(got) == len(contact_rows)
    texts = {}
    for i, t in contact_rows:
        texts.setdefault(i, []).append(t or "")
    for r in got:
        assert r.base in [plain(t) for t in texts[r.doc_id]]
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [r.base.count(k) for k in I.KINDS]
        if r.doc_id is None or not 2000 <= r.doc_id < 2003:
            assert r.spans == r.base
        else:
            (kind, a, b) = r.spans.split(":")
            assert kind == "phone" and texts[r.doc_id][0][int(a) : int(b)] == f"010-77{100 + r.doc_id - 2000}"


def test_learned_spans_stand_in_order(documents, contact_rows):
    both = [*contact_rows, (5000, "mail a@b.org please ring us at 010-77999 or b@b.org")]
    (r,) = I.find_personal_data(documents(both)).filter("doc_id = 5000").collect()
    assert r.base == "email:5:12,email:44:51" and r.spans == "email:5:12,phone:31:40,email:44:51"


def test_runs_of_digits_are_one_token():
    found = lambda text: [text[a:b] for a, b in I.likely_tokens(text, I.base_spans(text))]
    assert found("call (555) 123-4567, or ring 555 123 4567.") == ["(555) 123-4567", "555 123 4567"]
    assert found("card 4111 1111 1111 1112 (or [555] 123.4567)") == ["4111 1111 1111 1112", "[555] 123.4567"]
    assert found("(555)123-4567 555 (1234) 12 34 x 123456, 234567  345678") == ["(555)123-4567 555 (1234) 12 34", "123456", "234567", "345678"]
    assert found("4111 1111 1111 1111 and ab123cd 99 a@b 12:30:45 1 2") == ["ab123cd", "12:30:45"]
    assert found("no12") == found("12 34") == found("") == []
    assert len(found("1 " * 200_000)) == 1


def test_contexts_find_digits_with_blanks(documents, words):
    r = random.Random(5)
    w = lambda: " ".join(r.choice(words) for _ in range(8))
    rows = [(i, f"{w()} please call +1 (555) 010-{1000 + i} or {w()}") for i in range(40)]
    rows += [(100 + i, f"{w()} pay by card 4111 1111 1111 {x} or {w()}") for i, x in enumerate(y for y in range(1000, 2000) if luhn(f"411111111111{y}"))]
    asked = {2000: ("call", "phone", "(555) 123-4567"), 2001: ("call", "phone", "555 123 4567"), 2002: ("card", "card", "4111 1111 1111 1112")}
    rows += [(i, f"{w()} {'please' if a == 'call' else 'pay by'} {a} {t} or {w()}") for i, (a, _, t) in asked.items()]
    texts = dict(rows)
    for got in I.find_personal_data(documents(rows)).filter("doc_id >= 2000").collect():
        kind, a, b = got.spans.split(":")
        assert (kind, texts[got.doc_id][int(a) : int(b)]) == asked[got.doc_id][1:]


def test_long_numbers_in_addresses():
    for text, want in (("0" * 5000 + "1.2.3.4", "ip:0:5007"), ("9" * 5000 + ".1.2.3", ""), ("1.2.3." + "0" * 5000, "ip:0:5006")):
        assert I.joined(I.base_spans(text)) == want


def test_many_spans_before_a_token():
    text = "1.1.1.1," * 20 + "ab12345"
    spans = I.base_spans(text)
    assert len(spans) == 20 and list(I.likely_tokens(text, spans)) == []
    apart = text.replace(",ab", ", ab")
    assert [apart[a:b] for a, b in I.likely_tokens(apart, spans)] == ["ab12345"]


def plain_scores(rows, rounds=I.ROUNDS):
    """The graph of patterns and instances in dictionaries: what each document's learned spans must be."""
    edges, marks = {}, []
    for n, (_, text) in enumerate(rows):
        text = text or ""
        base = I.base_spans(text)
        others = [(a, b, "secret" if re.fullmatch("[0-9a-fA-F]{24,}", text[a:b]) and re.search("[a-fA-F]", text[a:b]) and re.search("[0-9]", text[a:b]) else None) for a, b in I.likely_tokens(text, base)]
        for a, b, k in [*base, *others]:
            for p in I.contexts(text, a, b):
                old = edges.get((p, text[a:b].lower()))
                edges[p, text[a:b].lower()] = min((x for x in (old, k) if x), default=None)
        marks += [(n, a, b, text[a:b].lower(), I.contexts(text, a, b)) for a, b, _ in others]
    belief, trusted, of = {}, None, {}
    for (p, i), k in edges.items():
        of.setdefault(p, []).append((i, k))
    for _ in range(rounds):
        score = {}
        for p, own in of.items():
            for kind in I.LEARNED:
                held = [1.0 if k == kind else belief.get((i, kind), 0.0) if k is None else 0.0 for i, k in own]
                if sum(h > 0 for h in held) >= I.SUPPORT and sum(held) / len(own) >= I.TRUST:
                    score[p, kind] = sum(held) / len(own)
        if trusted is not None and len(score) == len(trusted):
            break
        trusted = score
        belief = {}
        for (p, i), k in edges.items():
            for kind in I.LEARNED:
                if k is None and (p, kind) in score:
                    belief[i, kind] = max(belief.get((i, kind), 0.0), score[p, kind])
    learned = {}
    for n, a, b, _, patterns in marks:
        best = max(((trusted[p, k], -I.LEARNED.index(k), k) for p in patterns for k in I.LEARNED if (p, k) in trusted), default=None)
        if best:
            learned.setdefault(n, []).append((a, b, best[2]))
    return ["" if n not in learned else I.joined(sorted(learned[n])) for n in range(len(rows))]


@pytest.fixture(scope="module")
def secret_rows(words):
    """Keys in quotes, most of them hexadecimal; numbers of the same look elsewhere; a second context that only the first one's finds lead to."""
    r = random.Random(12)
    w = lambda: " ".join(r.choice(words[:300]) for _ in range(6))
    key = lambda: "".join(r.choice("0123456789abcdef") for _ in range(40))
    odd = [f"zq{n}-Key{n * 7}" for n in range(30)]
    rows = [(n, f'{w()} token = "{key()}" {w()}') for n in range(800)]
    rows += [(1200 + n, f'{w()} token = "{x}" {w()}') for n, x in enumerate(odd)]
    rows += [(1300 + n, f"{w()} login with <{x}> {w()}") for n, x in enumerate(odd)]
    rows += [(1400, f"{w()} login with <new77key> {w()}"), (1401, f"{w()} number {key()} {w()}"), (1402, f'{w()} page = "12345678" {w()}'), (1403, f'TOKEN = "{key().upper()}"!! {w()}')]
    return rows


def test_learned_spans_against_plain_scores(documents, secret_rows, contact_rows):
    rows = [(n, t) for n, (_, t) in enumerate([*secret_rows, *contact_rows])]
    want = plain_scores(rows)
    got = {r.doc_id: r for r in I.find_personal_data(documents(rows)).collect()}
    for n, text in rows:
        base = [x for x in got[n].base.split(",") if x]
        assert sorted(x for x in got[n].spans.split(",") if x not in base and x) == sorted(x for x in want[n].split(",") if x), text[:200]


def test_bootstrapping_reaches_further_in_each_round(documents, secret_rows):
    """Hexadecimal seeds make ``token = "_"`` trusted, its other tokens make ``login with <_>`` trusted, which finds a token nobody knew."""
    found = lambda **o: {r.doc_id: r.spans for r in I.find_personal_data(documents(secret_rows), **o).collect()}
    texts, all_rounds, one = dict(secret_rows), found(), found(rounds=1)
    free = {n for n, t in secret_rows if not I.base_spans(t)}  # a few keys hold twelve digits that make a card
    assert len(free) > 800 and all(all_rounds[n].startswith("secret:") for n in free & {*range(800), *range(1200, 1230), *range(1300, 1330), 1400, 1403})
    _, a, b = all_rounds[1400].split(":")
    assert texts[1400][int(a) : int(b)] == "new77key" and one[1400] == "" and all_rounds[1401] == all_rounds[1402] == ""


def test_keys_of_the_given_documents_are_found(spark):
    rows = Q.QUERIES["op4_personal_data"](spark, "/root/testdata/sf0.01").collect()
    texts = {r.doc_id: r.text or "" for r in Q.table(spark, "/root/testdata/sf0.01", "documents").collect()}
    keys = [i for i, t in texts.items() if re.search('token = "[0-9a-f]{40}"', t)]
    spans = {r.doc_id: r.spans for r in rows}
    assert len(keys) > 8 and all("secret:" in spans[i] or I.base_spans(texts[i]) for i in keys)
    assert all(re.search("token", texts[i], re.I) for i, s in spans.items() if "secret:" in s)


def test_empty_table(documents):
    assert I.find_personal_data(documents([])).count() == 0
    assert [tuple(r) for r in I.find_personal_data(documents([(1, None)])).collect()] == [(1, 0, 0, 0, 0, "", "")]
