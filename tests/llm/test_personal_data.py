import hashlib
import re

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from ratingloom.llm import personal_data as P

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def brute(text):
    """The rules as they are stated."""
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            total = sum(int(d) if k % 2 == 0 else sum(divmod(2 * int(d), 10)) for k, d in enumerate(reversed(digits)))
            ok = {"email": True, "ip": all(int(p) <= 255 for p in m[0].split(".")) if kind == "ip" else True,
                  "card": 12 <= len(digits) <= 19 and total % 10 == 0, "phone": 9 <= len(digits) <= 15}[kind]
            if ok:
                out.append((kind, *m.span()))
    return sorted(out, key=lambda s: (s[1], P.KINDS.index(s[0])))


@settings(max_examples=500, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("aZ09._%+-@ ()12345é日")), max_size=60))
def test_rules_equal_their_statement(text):
    assert P.rule_spans(text) == brute(text)


@pytest.mark.parametrize("text", [
    "x 4111 1111 1111 1111 y", "4111-1111-1111-1111.", "a.b@c.d.e@f.g", "@a.b c@d", "1.2.3.4.5.6.7.8", "300.1.1.1 255.255.255.255", "+1 (743) 555-3824.", "0001.002.0000.1", "+12", "a@b@c.d", "日本 +1 (743) 555-3824"])
def test_rules_on_examples(text):
    assert P.rule_spans(text) == brute(text)


def test_rules_are_linear_on_long_runs():
    assert P.rule_spans("1" * 300_000 + "a" * 300_000 + "@" * 1000 + "." * 300_000) == []


def test_slopes_equal_differences(monkeypatch):
    net = P.Network.fresh()
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    r = np.random.default_rng(0)
    x, y = r.integers(0, P.SYMBOLS, (7, 3)), r.integers(0, P.TAGS, (7, 3))
    _, grads = net.gradients(x, y)
    for name, value in net.p.items():
        at = np.unravel_index(np.abs(grads[name]).argmax(), value.shape)
        kept = value[at]
        value[at] = kept + 1e-5
        up = net.gradients(x, y)[0]
        value[at] = kept - 1e-5
        down = net.gradients(x, y)[0]
        value[at] = kept
        assert np.isclose((up - down) / 2e-5, grads[name][at], rtol=1e-4), name


def test_the_best_path_is_the_best_of_all():
    import itertools

    net = P.Network.fresh()
    r = np.random.default_rng(1)
    net.p["trans"] = r.standard_normal((P.TAGS, P.TAGS))
    s = r.standard_normal((4, P.TAGS))
    score = lambda y: sum(s[t, y[t]] for t in range(4)) + sum(net.p["trans"][y[t - 1], y[t]] for t in range(1, 4))
    assert tuple(net.path(s)) == max(itertools.product(range(P.TAGS), repeat=4), key=score)


@pytest.fixture(scope="module")
def network(spark):
    return P.fit(spark.read.parquet("/root/testdata/sf0.1/documents.parquet"), 250)


def test_network_finds_held_out_spans(spark, network):
    texts = [r.text for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("text").collect()]
    texts = [t for t in texts if P._SIGN.search(t)]
    hit = extra = want = 0
    for t, found in zip(texts, P.network_spans(network, texts), strict=True):
        base = set(P.rule_spans(t))
        hit, extra, want = hit + len(base & set(found)), extra + len(set(found) - base), want + len(base)
    assert hit / want > 0.9 and extra / want < 0.1


def test_windows_do_not_change_with_neighbours(network):
    texts = ["a " * 100 + "mail me at some.body@mail5.example.com now " + "b " * 100, "call +1 (743) 555-3824 " * 40]
    alone = [P.network_spans(network, [t])[0] for t in texts]
    assert P.network_spans(network, texts * 3) == alone * 3


def test_rows_of_every_kind(spark, network):
    rows = [(1, "to a.b@c.de or 1.2.3.4"), (2, None), (3, ""), (4, "none " * 50_000), (1, "to a.b@c.de or 1.2.3.4"), (None, "+1 (743) 555-3824")]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id bigint, text string, spans string")
    got = P.report(docs).collect()
    assert len(got) == len(rows)
    for r in got:
        text = dict(rows)[r.doc_id] or ""
        base = ",".join(f"{k}:{a}:{e}" for k, a, e in brute(text))
        assert r.base_sha256 == hashlib.sha256(base.encode()).hexdigest()
        assert set(filter(None, base.split(","))) <= set(r.spans.split(","))
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(sum(s[0] == k for s in brute(text)) for k in P.KINDS)
    assert P.report(docs.limit(0)).count() == 0
    assert P.fit(docs.filter("doc_id = 3")) is None
    assert P.masked("to a.b@c.de or 1.2.3.4", P.rule_spans("to a.b@c.de or 1.2.3.4")) == "to <EMAIL> or <IP>"
