import hashlib
import random
import re

import pytest

from auricle.llm import pii
from tests.llm.conftest import ODD, ODD_IDS, ids

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (2 if k % 2 else 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def base(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            good = {
                "email": True,
                "ip": kind != "ip" or all(int(p) <= 255 for p in m[0].split(".")),
                "card": 13 <= len(digits) <= 19 and luhn(digits),
                "phone": 9 <= len(digits) <= 15,
            }[kind]
            if good:
                out.append((kind, m.start(), m.end()))
    return out


def listed(spans):
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


HARD = [
    "a@b.com_c@d.org x@y.z.@q a@b..c a.@-.- a@b.c-d.e.",
    "1.2.3.4.5.6.7.8 256.1.1.1 001.02.3.255 1.2.3 9.9.9.9.",
    "4111 1111 1111 1111 4111-1111-1111-1111x 41111111111111112 4111  1111 5500005555555559",
    "+1 (988) 555-2485 +12 ++33 1 23 45 67 89 +1((((5 +49-30-123456-7.",
    "\U0001f600é a@b.co 日本 +1 988 555 2485 ip 10.0.0.1",
    "a@b.c.d@e.f 1.1.1.1@2.2 +1.2.3.4.5.6.7.8.9",
    "0 1 2 3 4 5 6 7 8 9 0 1 2 3 4 5 6 7 8 9 0 1 2 3",
    "4242424242424242 - 4242 4242 4242 4242- 378282246310005",
]


def check(found, texts):
    assert len(found) == len(texts)
    for r in found:
        want = base(texts[r["doc_id"]])
        for kind in PATTERNS:
            assert r[f"n_{kind}"] == sum(k == kind for k, _, _ in want), (texts[r["doc_id"]], kind)
        assert r["base_sha256"] == hashlib.sha256(listed(want).encode()).hexdigest()
        spans = [s for s in r["spans"].split(",") if s]
        assert set(listed(want).split(",")) - {""} <= set(spans)


def test_base_spans(docs):
    rng = random.Random(5)
    alphabet = ["a", "B", "9", "1", ".", "@", "-", " ", "+", "(", ")", "%", "é", "\n", "255", "a@b.c", "10.0.0.1"]
    texts = HARD + ["".join(rng.choices(alphabet, k=rng.randint(1, 60))) for _ in range(500)]
    digits = ["".join(rng.choices("0123456789  -", k=40)) for _ in range(200)]
    texts = dict(enumerate(texts + digits))
    check(pii.personal_data(docs([(k, t, None) for k, t in texts.items()])).collect(), texts)


def test_odd_rows(odd):
    found = pii.personal_data(odd)
    assert ids(found) == ODD_IDS
    check(found.where("doc_id <> 6 and doc_id is not null").collect(),
          {k: t for k, t, _ in ODD if k not in (6, None)})


def test_method_adds_spans_and_leaves_plain_text_alone(docs):
    rows = [(k, f"please call {k}00 555 123{k % 10} or write to tel. a{k}@mail.example.com now", None) for k in range(100, 160)]
    rows += [(1, "my tel 415-555-2671 is private", None), (2, "version 415-555-2671 of the build", None)]
    rows += [(3, "contact Mr. James Miller today", None), (4, "jane [at] mail [dot] com", None), (5, "nothing here", None)]
    got = {r["doc_id"]: r["spans"] for r in pii.personal_data(docs(rows)).collect()}
    assert got[1] == "phone:7:19"
    assert got[5] == ""
    assert got[3] == "name:8:24"
    assert got[4] == "email:0:24"


def test_estimate_finds_the_reliable_labeler():
    patterns = {(1, 1, 1, 1): 500, (0, 0, -1, 0): 400, (1, -1, 1, 1): 80, (-1, 0, 0, 0): 60, (0, 1, -1, 1): 2}
    belief = pii.estimate(patterns)
    assert belief.posterior((1, 1, 1, 1)) > 0.99
    assert belief.posterior((0, 0, -1, 0)) < 0.01
    assert 0.4 < belief.prior < 0.7


def test_redaction(docs, odd):
    rows = [(1, "écris à a@b.com ou 10.0.0.1, merci", None), (2, None, None), (3, "plain", None), (4, "a@b.com", None)]
    got = {r["doc_id"]: r for r in pii.redacted(docs(rows)).collect()}
    assert got[1]["text"] == "écris à [EMAIL] ou [IP], merci"
    assert got[1]["n_chars"] == len(got[1]["text"])
    assert got[2]["text"] is None and got[3]["text"] == "plain" and got[4]["text"] == "[EMAIL]"
    changed = pii.redacted(odd)
    assert changed.columns == odd.columns and ids(changed) == ODD_IDS


def test_empty_table(empty):
    assert pii.personal_data(empty).collect() == []
    assert pii.redacted(empty).collect() == []


@pytest.mark.parametrize("query", [pii.personal_data, pii.redacted])
def test_plan_has_no_python(odd, query):
    plan = query(odd)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
