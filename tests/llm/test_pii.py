import hashlib
import random
import re

from tidewater.llm import pii

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def brute(text):
    def luhn(d):
        total = 0
        for k, c in enumerate(reversed(d)):
            v = int(c) * (1 + k % 2)
            total += v - 9 if v > 9 else v
        return total % 10 == 0

    digits = lambda s: "".join(c for c in s if c in "0123456789")
    out = [(0, m.start(), m.end()) for m in EMAIL.finditer(text)]
    out += [(1, m.start(), m.end()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]
    out += [(2, m.start(), m.end()) for m in CARD.finditer(text) if 16 <= len(digits(m[0])) <= 19 and luhn(digits(m[0]))]
    out += [(3, m.start(), m.end()) for m in PHONE.finditer(text) if 8 <= len(digits(m[0])) <= 15]
    return sorted(out)


def test_base_spans_equal_the_plain_patterns(documents):
    r = random.Random(5)
    alphabet = ["a", "b.", "@", "a@b.c", ".", "-", "+", "1", "4242", " ", "(", ")", "255", "4111 1111 1111 1111", "_", "é", "x.y", "\n", "%"]
    texts = [t or "" for _, t, _, _ in documents] + ["".join(r.choices(alphabet, k=r.randint(0, 30))) for _ in range(4000)]
    for t in texts:
        assert sorted(pii.base_spans(t)) == brute(t), t


def test_long_texts_are_linear():
    for t in ("a" * 400_000 + "@", "1" * 300_000, "1." * 100_000, "@" * 200_000, "+1" + " " * 300_000, "a" * 400_000 + "@b.c"):
        pii.base_spans(t)
    assert pii.base_spans("a" * 400_000 + "@b.c") == [(0, 0, 400_004)]


def test_field_adds_only_what_is_free():
    model = pii.trained()
    base, added = pii.all_spans("call (988) 555-2485 or mail a.b@c.org, card 4041 8949 7460 8795", model)
    assert (3, 5, 19) in added and (0, 28, 37) in base
    for t in ("on 2024-01-31 at 10:20:30", "version 1.2.3, 12,345,678 items", "no data at all", "serial 12345678901234567890123"):
        assert pii.all_spans(t, model) == ([], [])
    # the phone pattern swallows the address behind it and drops both; the field finds the phone
    base, added = pii.all_spans("+1 (988) 555-2485 42.144.35.254", model)
    assert base == [(1, 18, 31)] and added == [(3, 0, 17)]


def test_decoding_is_the_best_of_all_segmentations():
    model = pii.trained()
    for text in ("+1 988 555 2485", "a@b.co 10.0.0.1", "(212) 555-0100 x", "4111111111111111"):
        bounds, ends = pii.lattice(text, 0, len(text))
        n = len(bounds) - 1

        def total(segments):
            at, prev, s = 0, model.OUT, 0.0
            starts = {i: (k, j) for k, i, j in segments}
            while at < n:
                k, j = starts.get(at, (model.OUT, at + 1))
                s += model.move[prev][k]
                s += next((model.score(k, on) for i, kind, on in ends[j] if (i, kind) == (at, k)), 0.0) if k != model.OUT else 0.0
                at, prev = j, k
            return s

        def every(at):
            if at >= n:
                yield []
                return
            for rest in every(at + 1):
                yield rest
            for j in range(at + 1, n + 1):
                for i, k, _ in ends[j]:
                    if i == at:
                        for rest in every(j):
                            yield [(k, i, j), *rest]

        best = max(total(s) for s in every(0))
        assert abs(total(model.decode(ends)) - best) < 1e-9


def test_gradient_matches_differences():
    model = pii.trained()
    import math

    text = "+1 988 555 2485 and 10.0.0.1"
    bounds, ends = pii.lattice(text, 0, len(text))
    at = {b: i for i, b in enumerate(bounds)}
    gold = {(3, 0, at[15])}

    def log_likelihood(m):
        out, n = m.OUT, len(ends) - 1
        ahead = [[-math.inf] * (out + 1) for _ in range(n + 1)]
        ahead[0][out] = 0.0
        add = lambda v: max(v) + math.log(sum(math.exp(x - max(v)) for x in v)) if max(v) > -math.inf else -math.inf
        for j in range(1, n + 1):
            for k in range(out + 1):
                arcs = [(j - 1, 0.0)] if k == out else [(i, m.score(k, on)) for i, kind, on in ends[j] if kind == k]
                values = [ahead[i][p] + m.move[p][k] + s for i, s in arcs for p in range(out + 1)]
                ahead[j][k] = add(values) if values else -math.inf
        j, prev, s = 0, out, 0.0
        starts = {i: (k, e) for k, i, e in gold}
        while j < n:
            k, e = starts.get(j, (out, j + 1))
            s += m.move[prev][k] + (next(m.score(k, on) for i, kind, on in ends[e] if (i, kind) == (j, k)) if k != out else 0.0)
            j, prev = e, k
        return s - add(ahead[n])

    grad = {}
    for name, a, b, g in model.gradient(ends, gold):
        grad[name, a, b] = grad.get((name, a, b), 0.0) + g
    for name, a, b in list(grad)[:40]:
        table = getattr(model, name)
        table[a][b] += 1e-5
        up = log_likelihood(model)
        table[a][b] -= 2e-5
        down = log_likelihood(model)
        table[a][b] += 1e-5
        assert abs((up - down) / 2e-5 - grad[name, a, b]) < 1e-4


def test_query_digests(spark, make_docs, as_documents):
    text = "é mail x.y@z.com and 10.0.0.1 then +1 (988) 555-2485 or (212) 555-0100"
    rows = [(1, text, "en", "s"), (1, text, "en", "s"), (2, None, None, None), (None, "", "en", "s")]
    got = pii.op2_pii(spark, as_documents(make_docs(rows))).collect()
    base = brute(text)
    joined = ",".join(f"{pii.KINDS[k]}:{s}:{e}" for k, s, e in base)
    one = [r for r in got if r["doc_id"] == 1]
    assert len(got) == 4 and len(one) == 2 and one[0] == one[1]
    assert one[0]["base_sha256"] == hashlib.sha256(joined.encode()).hexdigest()
    assert [one[0][f"n_{k}"] for k in pii.KINDS] == [1, 1, 0, 1]
    start = text.index("(212)")
    assert f"phone:{start}:{start + 14}" in one[0]["spans"].split(",") and one[0]["spans"].startswith("email:7:16,ip:")
    empty = next(r for r in got if r["doc_id"] == 2)
    assert empty["spans"] == "" and empty["base_sha256"] == hashlib.sha256(b"").hexdigest()


def test_redaction_keeps_the_frame(make_docs):
    docs = make_docs([(1, "a x@y.org b", "en", "s"), (2, None, "en", "s"), (3, "clean", None, None)]).selectExpr("*", "1 AS base", "2 AS found")
    out = {r["doc_id"]: r["text"] for r in pii.redact(docs).collect()}
    assert pii.redact(docs).schema == docs.schema
    assert out == {1: "a [EMAIL] b", 2: None, 3: "clean"}
    assert pii.redact(make_docs([])).count() == 0
