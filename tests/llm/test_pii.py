import hashlib
import re

from tidemark.llm import pii

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits):
    total = 0
    for k, d in enumerate(reversed(digits)):
        v = int(d) * (1 + k % 2)
        total += v - 9 * (v > 9)
    return total % 10 == 0


def base_spans(text):
    found = []
    for rank, (kind, pattern) in enumerate((("email", EMAIL), ("ip", IP), ("card", CARD), ("phone", PHONE))):
        for m in pattern.finditer(text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            ok = {
                "email": True,
                "ip": kind == "ip" and all(int(x) <= 255 for x in m[0].split(".")),
                "card": 14 <= len(digits) <= 19 and luhn(digits),
                "phone": 10 <= len(digits) <= 15,
            }[kind]
            if ok:
                found.append((m.start(), rank, m.end(), kind))
    return sorted(found)


def expect(text):
    found = base_spans(text)
    line = ",".join(f"{k}:{a}:{b}" for a, _, b, k in found)
    return [sum(f[3] == k for f in found) for k in ("email", "ip", "card", "phone")] + [hashlib.sha256(line.encode()).hexdigest()]


CASES = [
    "write to a.b+c@d-e.fr.x or x@y@z.com, a@b.c_x@y.z. end@nodot",
    "1.2.3.4.5.6.7.8 256.1.1.1 0001.02.003.255 1.2.3 9.9.9.9",
    "4111 1111 1111 1111 and 4111-1111-1111-1112, 4111  1111 1111 1111 49927398716",
    "+1 (437) 555-0689 ++44 20 7946 0958 +12 +1234567890123456 é+1 555 123 4567",
    "card 4111111111111111 iban DE89 3704 0044 0532 0130 00 GB82WEST12345698765432 DE00370400440532013000",
    "ssn 123-45-6789 and 123-45-6780 without",
    "\U0001f600 mail me@x.org \U0001f600 8.8.8.8",
    "1 2 " * 20000 + "a." * 20000 + "@b" + ".c" * 20000,
    "7" * 30000,
]


def test_base_spans_equal_plain_matching(frame, odd_texts):
    rows = list(enumerate(CASES)) + [(i, t) for i, t in odd_texts]
    got = pii.personal_data(frame(rows)).collect()
    want = sorted([(i if i is not None else -1, *expect(t)) for i, t in rows], key=str)
    kept = sorted([(r.doc_id if r.doc_id is not None else -1, r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256) for r in got], key=str)
    assert kept == want


def test_added_kinds_need_their_checks(frame):
    rows = {r.doc_id: r for r in pii.personal_data(frame(list(enumerate(CASES)))).collect()}
    assert rows[4].n_iban == 2 and "iban:27:54" in rows[4].spans
    assert rows[5].n_ssn == 2
    assert pii.personal_data(frame([(1, "number 123-45-6789 only")])).first().n_ssn == 0


def test_context_moves_the_score(frame):
    near, far = pii.personal_data(frame([(1, "host 8.8.8.8"), (2, "so 8.8.8.8")])).orderBy("doc_id").collect()
    assert float(near.scores) > float(far.scores)


def test_redaction(frame):
    assert pii.redact(frame([(1, "to me@x.org now"), (2, None)])).orderBy("doc_id").collect() == [(1, "to <email> now"), (2, "")]


def test_no_rows(frame):
    assert pii.personal_data(frame([])).count() == 0


def test_kinds_with_one_start_come_as_listed(frame):
    texts = ["10.0.0.1@host.org", "4111111111111111@mail.com"]
    rows = pii.personal_data(frame(list(enumerate(texts)))).orderBy("doc_id").collect()
    assert [r.spans.split(",")[:2] for r in rows] == [["email:0:17", "ip:0:8"], ["email:0:25", "card:0:16"]]
    assert [r.base_sha256 for r in rows] == [expect(t)[4] for t in texts]
