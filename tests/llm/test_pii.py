import random
import re

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from argent.llm.pii import base_spans, emails, find_pii, fit, fit_spans, luhn, spans_of

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def _digits(s):
    return re.sub("[^0-9]", "", s)


def _brute(text):
    out = [("email", *m.span()) for m in EMAIL.finditer(text)]
    out += [("ip", *m.span()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m.group().split("."))]
    out += [("card", *m.span()) for m in CARD.finditer(text) if 16 <= len(_digits(m.group())) <= 19 and luhn(_digits(m.group()))]
    out += [("phone", *m.span()) for m in PHONE.finditer(text) if 8 <= len(_digits(m.group())) <= 15]
    return out


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="ab1290.@-+ ()_%é漢\n", max_size=60))
def test_base_equals_the_plain_patterns(text):
    assert base_spans(text) == _brute(text)


def test_emails_and_long_texts():
    assert list(emails("a@b.c@d.e")) == [m.span() for m in EMAIL.finditer("a@b.c@d.e")]
    for long in ("1" * 200_000, "a" * 200_000 + "@", "+" * 50_000, "1." * 50_000, "@" * 50_000, "a@" * 30_000, "4111 1111 1111 1111 " * 2000):
        if long[:2] != "11":
            assert base_spans(long) == _brute(long)
        else:
            assert base_spans(long) == []


def test_em_finds_reliable_labelers():
    rng = np.random.default_rng(3)
    truth = rng.random(4000) < 0.4
    votes = np.stack([np.where(rng.random(4000) < r, truth, ~truth).astype(int) for r in (0.95, 0.9, 0.6)], axis=1)
    model = fit(votes, truth[:, None].astype(int), np.ones(4000))
    assert model.sensitivity[0] > 0.9 > model.sensitivity[2] and abs(model.prior - 0.4) < 0.1
    assert model.score((1,)) > 0.9 > 0.1 > model.score((0,))


def _corpus(rng):
    rows = []
    for i in range(300):
        words = ["lorem", "ipsum", "dolor"] * 5
        rng.shuffle(words)
        words.insert(4, rng.choice(["mail x%d@mail.example.com" % i, "ip 10.0.%d.7" % (i % 256), "card 4111111111111111", "call +1 (456) 555-2186"]))
        words.insert(2, "AKIA" + "".join(rng.choice("ABCDEFGHJK23456789") for _ in range(16)) if i % 3 == 0 else "version 3.0.")
        words.append("password=" + "".join(rng.choice("0123456789abcdef") for _ in range(18)) if i % 2 else "License 2.0, section 12")
        rows.append((i, " ".join(words)))
    return rows


def test_the_method_adds_secrets_and_keeps_versions_out(spark):
    rows = _corpus(random.Random(2))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    model = fit_spans(df)
    for i, t in rows:
        base, spans = spans_of(t, model)
        assert base == _brute(t) and set(base) <= set(spans)
        added = {t[a:z] for _, a, z in set(spans) - set(base)}
        assert any(x.startswith("AKIA") for x in added) == (i % 3 == 0)
        assert not any(x.startswith(("2.0", "3.0", "12")) for x in added)


def test_nulls_empty_and_repeats(spark):
    rows = [(1, None, "x"), (2, "", "x"), (None, "a@b.co", "y"), (3, "a@b.co", "z"), (3, "a@b.co", "z")]
    df = spark.createDataFrame(rows, "doc_id long, text string, spans string")
    got = sorted((r.doc_id or 0, r.n_email, r.base_spans) for r in find_pii(df).collect())
    assert got == [(0, 1, "email:0:6"), (1, 0, ""), (2, 0, ""), (3, 1, "email:0:6"), (3, 1, "email:0:6")]
    assert find_pii(df.limit(0)).count() == 0
