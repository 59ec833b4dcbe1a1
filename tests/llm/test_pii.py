import hashlib
import random
import re

from hearth.llm import op2_pii as op
from tests.llm.helpers import crowded, docs

BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(d):
    total = 0
    for i, c in enumerate(reversed(d)):
        x = int(c) * (1 + i % 2)
        total += x - 9 * (x > 9)
    return total % 10 == 0


def brute(text):
    out = []
    for kind, p in BASE.items():
        for m in re.finditer(p, text or ""):
            d = re.sub("[^0-9]", "", m[0])
            ok = {"email": True, "ip": all(int(x) <= 255 for x in m[0].split(".")) if kind == "ip" else True,
                  "card": 13 <= len(d) <= 19 and luhn(d), "phone": 9 <= len(d) <= 15}[kind]
            if ok:
                out.append(f"{kind}:{m.start()}:{m.end()}")
    return out


def check(spark, texts):
    got = {r["doc_id"]: r for r in op.pii_digest(docs(spark, list(enumerate(texts)))).collect()}
    for i, t in enumerate(texts):
        want = brute(t)
        spans = [s for s in got[i]["spans"].split(",") if s and s.split(":")[0] in BASE]
        assert spans == want, (t, spans, want)
        assert got[i]["base_sha256"] == hashlib.sha256(",".join(want).encode()).hexdigest()
        for k in BASE:
            assert got[i][f"n_{k}"] == sum(s.startswith(k + ":") for s in want)
    return got


def test_fixed_cases(spark):
    check(spark, ["", "a@b.c_d@e.f", "a@b.c.d@e.f.", "1.2.3.4.5.6.7.8", "256.1.1.1 0001.0.0.255", "é𝄞 x@y.zz 10.0.0.1",
                  "4111 1111-1111 1111", "4111111111111112", "41111111111111111111111111", "+1 (319) 555-5132 ext", "+1..2",
                  "++49 30 1234567)", "a@@b.c a@b@c.d", "@x.y", "a@b..c", "1.2.3.", "1..2.3.4", "12-34--56 7"])


def test_random_against_brute_force(spark):
    rng = random.Random(5)
    parts = ["a.b", "@", "x-y", ".", "1", "23", "255", "4111111111111111", " ", "-", "+", "(", ")", "é", "_", "%", "\n", "00"]
    check(spark, ["".join(rng.choice(parts) for _ in range(rng.randrange(60))) for _ in range(400)])


def test_long_text_is_linear(spark):
    # the plain patterns take quadratic time on the first two, so these are not run through the brute force
    for text in ("x" * 200_000, "1" * 200_000):
        assert op.pii_digest(docs(spark, [(1, text)])).first()["spans"] == ""
    check(spark, ["1." * 20_000, "+1" + " 2" * 20_000, "a." * 4_000 + "@b.c", "m@n.op " * 3000])


def test_added_kinds_and_scores(spark):
    text = "bank account DE89 3704 0044 0532 0130 00 and GB82WEST12345698765432, not DE89370400440532013001; " + " " * 60 + \
           "078-05-1120" + " " * 60 + "ssn 078-05-1120; mail a@b.cd"
    r = op.pii_digest(docs(spark, [(1, text)])).first()
    assert r["n_iban"] == 2 and r["n_ssn"] == 1
    assert [s.split(":")[0] for s in r["spans"].split(",")] == ["email", "iban", "iban", "ssn"]
    scores = {s.rsplit(":", 1)[0]: int(s.rsplit(":", 1)[1]) for s in r["scored"].split(",")}
    assert sorted(scores.values()) == [80, 80, 95, 95]


def test_nulls_repeats_empty_and_clashes(spark):
    d = crowded(docs(spark, [(None, "a@b.c"), (1, None), (1, None), (2, "")]), "email", "spans", "s", "n_email", "at", "found")
    rows = op.pii_digest(d).collect()
    assert sorted((str(r["doc_id"]), r["spans"]) for r in rows) == [("1", ""), ("1", ""), ("2", ""), ("None", "email:0:5")]
    assert op.pii_digest(d.limit(0)).count() == 0


def test_no_python_in_plan(spark):
    plan = op.pii_digest(docs(spark, [(1, "x")]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_many_matches_in_a_text_are_linear(spark):
    import time

    def seconds(n):
        t = "server 10.0.0.1 abc " * n
        begin = time.time()
        got = op.pii_digest(docs(spark, [(1, t)])).first()
        assert got["n_ip"] == n and got["scored"].endswith(f"ip:{20 * n - 13}:{20 * n - 5}:70")
        return time.time() - begin

    seconds(100)  # planning and code generation
    few, many = seconds(4_000), seconds(64_000)
    assert many < few + 10  # a quadratic search takes over a minute here
    check(spark, ["m@n.op 1.2.3.4 " * 3_000 + "\U0001D11E " * 300 + " +49 30 1234567 mail a@b.cd"])


def test_windows_across_leaves_and_runs(spark):
    """Scores against plain windows, with spans at every place relative to the leaves' and runs' edges."""
    rng = random.Random(11)
    texts = []
    for i in range(60):
        gap = [rng.choice(["é", "x", " ", "server", "\U0001D11E", "ip "]) for _ in range(rng.randrange(400))]
        texts.append(" ".join("".join(gap[:rng.randrange(1, 120)]) + " 10.0.0.1 " for _ in range(rng.randrange(1, 140))) + "z" * i)
    rows = op.pii_digest(docs(spark, list(enumerate(texts)))).collect()
    for r in rows:
        t = texts[r["doc_id"]]
        want = []
        for m in re.finditer(BASE["ip"], t):
            around = t[max(0, m.start() - 40):m.start()] + "\n" + t[m.end():m.end() + 40]
            near = any(w in around for w in ("ip", "server", "host", "address", "adresse"))
            want.append(f"ip:{m.start()}:{m.end()}:{70 if near else 50}")
        assert [s for s in r["scored"].split(",") if s.startswith("ip:")] == want
