import random
import re

import numpy as np
import pytest
from edge_cases import SF, TEXTS, documents, no_documents

from predial.llm import boosting, continued, pii
from predial.llm.support import prepare, smallest_hashes


def plain(text):
    """The base rules by their plain patterns."""
    def digits(m):
        return re.sub("[^0-9]", "", m.group())

    def luhn(d):
        return sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(d[::-1])) % 10 == 0

    out = [("email", *m.span()) for m in
           re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text)
            if all(int(x) <= 255 for x in m.group().split("."))]
    out += [("card", *m.span()) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text)
            if 13 <= len(digits(m)) <= 19 and luhn(digits(m))]
    out += [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text)
            if 9 <= len(digits(m)) <= 15]
    return out


@pytest.mark.parametrize("letters", ["a@.-_+%1 é", "0123456789 .-", "+12 ().-3\n", "@a.b", "41 -"])
def test_base_rules_against_plain_patterns(letters):
    rng = random.Random(3)
    for _ in range(8000):
        text = "".join(rng.choice(letters) for _ in range(rng.randint(0, 32)))
        assert pii.base_spans(text) == plain(text)


def test_long_runs_are_read_once():
    for text in ("a" * 300_000, "1" * 300_000, "1." * 100_000, "a@" * 100_000, "+1" + " " * 300_000,
                 "1 " * 100_000, "a.b-" * 80_000 + "@"):
        pii.base_spans(text)
        pii.proposals(text)


@pytest.fixture(scope="module")
def model(spark):
    return pii.train(prepare(spark).read.parquet(f"{SF}/documents.parquet"))


def added(model, text):
    base = pii.base_spans(text)
    return [(s[0], text[s[1] : s[2]]) for s, _ in model.accepted(text, base) if s not in base]


def test_the_method_adds_what_the_rules_leave(model):
    assert added(model, "please call me at (555) 201-2345 today") == [("phone", "(555) 201-2345")]
    assert added(model, "write to john42 at mail dot com now") == [("email", "john42 at mail dot com")]
    assert added(model, "his SSN 219-09-9999 was seen")[0][1] == "219-09-9999"


def test_clean_texts_stay_clean(model):
    for text in ("on 2021-03-04 the total 1234567890123 was page 1234567", "ISBN 978-3-161-48410-0",
                 "version 1.2.3", "rows 10 20 30 40", "they look at this dot again", "time 10:20:30:40"):
        assert added(model, text) == []


def test_scores_separate_examples_held_back():
    x, y = pii.generated_examples(3000, seed=11)
    model = pii.fit_model(*pii.generated_examples(4000, seed=7))
    p = model.booster.probability(x)
    accepted = p >= model.thresholds[x[:, 0].astype(int)]
    assert y[accepted].mean() > 0.97 and accepted[y == 1].mean() > 0.8


def test_boosting_learns_an_interaction():
    rng = np.random.default_rng(0)
    x = rng.random((2000, 4))
    y = ((x[:, 0] > 0.5) ^ (x[:, 2] > 0.3)).astype(float)
    found = boosting.fit(x[:1500], y[:1500])
    found.calibrate(x[1500:], y[1500:])
    assert ((found.probability(x[1500:]) > 0.5) == y[1500:]).mean() > 0.95


def test_redaction(model):
    text = "a ana.b@mail.example.com b +1 (555) 010-2345 c"
    assert pii.redacted(text, pii.base_spans(text)) == "a [EMAIL] b [PHONE] c"
    assert pii.redacted("0123456789", [("phone", 2, 6), ("card", 4, 8)]) == "01[CARD]89"


def test_edges(spark, model):
    rows = pii.find(documents(spark), model).collect()
    got = sorted(((r.doc_id, [(s.kind, s.start, s.end) for s in r.base]) for r in rows), key=str)
    assert got == sorted(((i, plain(t or "")) for i, t in TEXTS), key=str)
    for r in rows:
        assert {(s.kind, s.start, s.end) for s in r.base} <= {(s.kind, s.start, s.end) for s in r.spans}
    df = documents(spark)
    clean = pii.redact(df, model)
    assert clean.columns == df.columns
    texts = {r.doc_id: r.text for r in clean.collect() if r.doc_id}
    assert texts[10] == "write to [EMAIL] or [PHONE] from [IP], [CARD]"
    assert texts[5] is None and texts[6] == "" and texts[1] == TEXTS[0][1]
    assert pii.find(no_documents(spark), pii.train(no_documents(spark))).count() == 0


def test_given_documents(spark, model):
    df = prepare(spark).read.parquet(f"{SF}/documents.parquet")
    texts = {r.doc_id: r.text or "" for r in df.collect()}
    for r in pii.find(df, model).collect():
        assert [(s.kind, s.start, s.end) for s in r.base] == plain(texts[r.doc_id])


def proposed(text):
    return {(k, text[s:e]) for k, s, e in pii.proposals(text)}


def test_each_run_of_groups_is_proposed(model):
    two = "555-201-2345 / 555-201-6789"
    assert {("phone", "555-201-2345"), ("phone", "555-201-6789")} <= proposed(two)
    assert ("phone", "555-201-2345") in proposed("call 555-201-2345 2024-11-06 ok")
    assert ("card", "4111 1111 1111 1111") in proposed("3 4111 1111 1111 1111")
    assert added(model, two) == [("phone", "555-201-2345"), ("phone", "555-201-6789")]
    assert added(model, "call 555-201-2345 2024-11-06 ok") == [("phone", "555-201-2345")]
    assert added(model, "3 4111 1111 1111 1111") == [("card", "4111 1111 1111 1111")]
    assert added(model, "rows 1 2 3 4 5 6 7 8 9 10 11 12 13 14 15 16 17 18 19 20 21") == []


def test_proposals_of_runs_against_all_pairs_of_ends():
    rng = random.Random(4)
    for _ in range(2000):
        text = "".join(rng.choice("0123456789012345 -/.(a") for _ in range(rng.randint(0, 28)))
        want = set()
        for a in (m.start() for m in re.finditer("(?<![0-9A-Za-z])[(+]?[0-9]", text)):
            for b in (m.end() for m in re.finditer("[0-9](?![0-9A-Za-z])", text)):
                size = sum(c.isdigit() for c in text[a:b])
                if a < b and "a" not in text[a:b] and not (text[a] == "(" and not text[a + 1 : a + 2].isdigit()):
                    # A bracket belongs to the span that it opens.
                    if text[a].isdigit() and a and text[a - 1] == "(" and not text[max(0, a - 2) : a - 1].isalnum():
                        continue
                    want |= {(k, a, b) for k, least, most in (("phone", 7, 15), ("id", 7, 12), ("card", 13, 19))
                             if least <= size <= most}
        assert {p for p in pii.proposals(text) if p[0] in ("phone", "id", "card")} == want, text


def test_long_chains_are_not_cut(model):
    card = "4111 1111 1111 1111"
    assert added(model, f"1001 2002 3003 4004 5005 {card}") == [("card", card)]
    for before in range(40):
        text = "".join(f"{1000 + 37 * i} " for i in range(before)) + card + " 2002 3003"
        assert ("card", card) in proposed(text)
    assert ("phone", "555-201     -     2345") in proposed("9 " * 50 + "555-201     -     2345")


def test_unknown_proposals_are_no_examples():
    unknown = "ring 555-201-2345, SSN 219-09-9999, or john42 at mail dot com, fe80:1:2:3:4:5:6:7"
    assert pii._weak_examples(unknown) == []
    labels = {}
    text = "+1 (555) 010-2345, on 2021-03-04, price 1.234.567, ISBN 978-3-161-48410-0, 4111 1111 1111 1112 and 10:20:30:40"
    for x in pii._weak_examples(text):
        labels.setdefault(pii.KINDS[int(x[0])], set()).add(x[-1])
    assert labels == {"phone": {0.0, 1.0}, "id": {0.0}, "card": {0.0}, "ip": {0.0}}
    assert not pii.against("IBAN DE89 3704 0044 0532 0130 00", ("iban", 5, 32))
    assert pii.against("see AB12 3456 7890", ("iban", 4, 18))


def test_the_sample_holds_every_kind():
    text = "a@b.cd, " * 200 + "4111 1111 1111 1112, 2021-03-04, 00:10:20:30, " * 50
    kinds = [pii.KINDS[int(x[0])] for x in pii._weak_examples(text)]
    assert {k: kinds.count(k) for k in set(kinds)} == dict.fromkeys(("email", "ip", "card", "phone", "id"), pii.SAMPLE_PER_DOC)


@pytest.mark.parametrize("address", ["ann at mail (dot) com", "ann at mail [dot] com", "ann at mail.com"])
def test_written_addresses_need_no_other_sign(model, address):
    for text in (address, f"write to {address} now", f"contact {address}. Thanks to all"):
        assert ("email", address) in proposed(text)
    assert added(model, f"write to {address} now") == [("email", address)]
    assert added(model, "We arrived at noon. Then she left at night. He stayed at home.") == []


@pytest.mark.parametrize("text, want", [
    ("tel. 1-800-555-0199", ("phone", "1-800-555-0199")),
    ("call me at 0049 170 1234567 now", ("phone", "0049 170 1234567")),
    ("DE89370400440532013000 is my IBAN", ("iban", "DE89370400440532013000")),
    ("my IBAN is DE89 3704 0044 0532 0130 00 with this bank", ("iban", "DE89 3704 0044 0532 0130 00")),
    ("iban de89370400440532013000 ok", ("iban", "de89370400440532013000")),
    ("passport C01X00T47 was lost", ("document", "C01X00T47")),
    ("host fe80::1ff:fe23:4567:890a is up", ("ip", "fe80::1ff:fe23:4567:890a")),
    ("write to ann AT mail DOT com now", ("email", "ann AT mail DOT com")),
    (f"write to {'a' * 70} at mail dot com", ("email", f"{'a' * 70} at mail dot com")),
    ("ann at mail dot a dot b dot c dot d dot e dot com", ("email", "ann at mail dot a dot b dot c dot d dot e dot com")),
])
def test_forms_beyond_the_rules(model, text, want):
    assert added(model, text) == [want]


def test_alike_but_not_personal(model):
    for text in ("version C01X00T47", "std::vector a::b use", "covid19 mp3 h264 abc12345", "see AB12 3456 7890",
                 "LOOK AT THIS. THEN GO", "::", "12:30:", "ab12 with this and that one"):
        assert added(model, text) == []


def test_colon_groups():
    def found(text):
        return [text[s:e] for k, s, e in pii._colons(text)]

    for whole in ("fe80::1", "::1", "fe80::", "2001:db8::8a2e:370:7334", "1:2:3:4:5:6:7:8", "00:1b:44:11:3a:b7"):
        assert found(f"at {whole} and") == [whole] and found(f"at {whole}: yes") == [whole] or whole.endswith("::")
    for other in ("::", ":::1", "1::2::3", "1:2:3", "1:2:3:4:5:6:7:8:9", "12345::1", "std::1", "fe80::1x"):
        assert found(f"at {other} and") == []


def test_accounts_end_after_each_group():
    text = "x DE89 3704 0044 0532 0130 00 with AB12_3456 7890 1234"
    found = {text[s:e] for k, s, e in pii._accounts(text)}
    assert {"DE89 3704 0044", "DE89 3704 0044 0532 0130 00", "DE89 3704 0044 0532 0130 00 with"} <= found
    assert not any(f.startswith("AB12") for f in found)


def test_forms_are_read_in_linear_time():
    for text in ("a." * 100_000 + "@b.c", "fe80:" * 60_000, "::" * 100_000, "ab12 " * 40_000,
                 "a at b dot " * 20_000, "@a" + ".b" * 60_000, "AB12" + "x" * 300_000):
        assert sum(1 for _ in pii._proposed(text)) <= len(text) * 2


def test_the_sample_of_rows_without_ids_is_full(spark):
    df = prepare(spark).createDataFrame([(None, f"text {i % 90}") for i in range(5000)], "doc_id long, text string")
    a = smallest_hashes(df, "doc_id", 20, ties=["text"]).collect()
    b = smallest_hashes(df.repartition(7), "doc_id", 20, ties=["text"]).collect()
    assert a == b and len(a) == 20


def test_sentences_and_forms_that_no_example_has():
    """Countries, names and sentences of their own: recall and precision of the made model."""
    made = pii.fit_model(*pii.generated_examples())
    rng = random.Random(5)

    def n(count):
        return "".join(rng.choice("0123456789") for _ in range(count))

    def valid(parts, check):
        return next(p for p in parts if check(p))

    def account():
        country, size = rng.choice((("AT", 16), ("PL", 24), ("BE", 12), ("IT", 22)))
        rest = n(size)
        return valid((f"{country}{c:02d}{rest}" for c in range(2, 99)), pii.passes_97)

    def card():
        first = f"5{rng.randint(1, 5)}{n(13)}"
        return valid((first + d for d in "0123456789"), pii.passes_luhn)

    cases = (
        (account, "Please pay into {} before Friday."),
        (lambda: f"{n(3)}-{n(3)}-{n(4)}", "You can reach our office on {} any weekday."),
        (lambda: f"({n(3)}) {n(3)}-{n(4)}", "For bookings ring {}, ask for Maria."),
        (lambda: f"{rng.choice(('carla', 'tom.s'))}{n(2)} [at] {rng.choice(('club', 'zeta'))} [dot] com", "Questions go to {} as always."),
        (lambda: f"2001:db8:{rng.randint(1, 65535):x}::{rng.randint(1, 65535):x}", "The machine answers at {} since Monday."),
        (card, "It was charged to {} last week."),
        (lambda: f"{n(3)}-{n(2)}-{n(4)}", "The applicant's social security number {} is on file."),
        (lambda: f"{rng.choice('ABCXY')}{n(8)}", "She travels on passport {} this time."),
    )
    hits, wrong, total = 0, 0, 0
    for make, sentence in cases:
        for _ in range(60):
            part = make()
            text = sentence.format(part)
            found = [text[s:e] for (_, s, e), _ in made.accepted(text, pii.base_spans(text))]
            hits, wrong, total = hits + (part in found), wrong + sum(f != part for f in found), total + 1
    assert hits / total >= 0.9 and hits / (hits + wrong) >= 0.97
    clean = ("The meeting of 2{a}-0{b}-1{b} moved to room {a}.", "Invoice {a}{a} totals {a}.{a} EUR.", "Chapter {a}.{a} runs to {a}.",
             "at {a}:{a}:{a} the train left", "ticket ABC{a}{a} closed", "commit {a}ab{a}cd{a}")
    for sentence in clean:
        for _ in range(40):
            text = sentence.format(a=n(2), b=rng.randint(1, 9))
            assert made.accepted(text, pii.base_spans(text)) == []


def test_all_labelled_proposals_of_all_rows_teach(spark):
    """Also of rows and proposals beyond any sample: 1,500 documents, 30 dates in one of them."""
    dates = " and ".join(f"2021-03-{d:02d}" for d in range(1, 31))
    rows = [(i, "call +1 (555) 010-2345 now" if i % 2 else "price 1.234.567 now") for i in range(1500)]
    df = prepare(spark).createDataFrame([*rows, (9999, dates), (None, None)], "doc_id long, text string").repartition(5)
    want = {}
    for _, text in [*rows, (0, dates)]:
        for p, label in pii.labelled(text):
            want[pii.KINDS.index(p[0]), int(label)] = want.get((pii.KINDS.index(p[0]), int(label)), 0) + 1
    found = pii.examples(df).groupBy("kind", "label").sum("n").collect()
    assert {(r.kind, r.label): r["sum(n)"] for r in found} == want
    assert want[pii.KINDS.index("phone"), 1] == 750 and sum(want.values()) > 2250


def test_a_late_row_changes_the_trees_and_the_partitioning_does_not(spark):
    """What few rows of a large table show is learnt, whichever rows they are."""
    text = "call me at 555-201-2345 now"
    clean = [(i, "nothing here") for i in range(3000)]
    shown = [(i, f"call me at 555-{200 + i % 700}-{1000 + i} EUR") for i in range(3000, 3600)]
    schema = "doc_id long, text string"
    model = pii.train(prepare(spark).createDataFrame([*clean, *shown], schema).repartition(7))
    again = pii.train(prepare(spark).createDataFrame([*shown, *clean], schema).repartition(2))
    plain = pii.train(prepare(spark).createDataFrame(clean, schema))
    price = "call me at 555-201-2345 EUR"
    x = np.array([pii.features(t, ("phone", 11, 23)) for t in (text, price)])
    p, q, r = (m.booster.probability(x) for m in (model, again, plain))
    assert (p == q).all() and (model.thresholds == again.thresholds).all()
    assert p[1] < r[1]


def test_trees_over_a_table_are_those_of_its_rows_in_memory(spark):
    """Sums per value find what a plain search over rows does: a level, with and without the table."""
    rng = np.random.default_rng(2)
    x = rng.integers(-1, 300, (400, 5)).astype(float)
    y = (x[:, 2] > 120).astype(float)
    kind = np.zeros(400, int)
    rows = [(0, int(v), False, bytearray(b.tobytes()), 1, 0.0) for b, v in zip(continued.as_bytes(x[:300]), y)]
    table = prepare(spark).createDataFrame(rows, f"{continued.EXAMPLES}, raw double").repartition(3)
    rest = continued.Examples(continued.as_bytes(x[300:]), kind[300:], y[300:], np.zeros(100), np.ones(100, int))
    whole = continued.Examples(continued.as_bytes(x), kind, y, np.zeros(400), np.ones(400, int))
    tree = continued.go_on(table, rest, np.array([1.0]), rounds=1)[0][0]
    alone = continued.go_on(table.limit(0), whole, np.array([1.0]), rounds=1)[0][0]
    assert tree.feature[0] == 2 and 110 < tree.limit[0] <= 120
    assert (tree.feature == alone.feature).all() and (tree.limit == alone.limit).all()
    assert np.allclose(tree.value, alone.value) and ((tree(x) > 0) == (y == 1)).all()
