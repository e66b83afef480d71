"""The model adds data in other forms also where many rows hold such data."""

import random

from tagwright.llm import pii


def test_a_third_in_other_forms(spark, docs_of):
    rng, rows, real, junk = random.Random(4), [], {}, {}
    for i in range(900):
        name, site = ("".join(rng.choices("abcdefgh", k=6)) for _ in range(2))
        phone = " ".join("".join(rng.choices("123456789", k=n)) for n in (2, 3, 3, 4))
        other = i % 3 == 0
        mail = f"{name} [at] {site}.org" if other else f"{name}@{site}.org"
        call = phone if other else "+" + phone
        bad = " ".join("".join(rng.choices("123456789", k=2)) for _ in range(3))
        text = f"Please write to {mail} or call {call} today. Item {bad} of version 700.{i % 90}.1.300 is sold."
        rows.append((i, text, "a"))
        if other:
            real[i] = [("email", text.index(mail), text.index(mail) + len(mail)), ("phone", text.index(call), text.index(call) + len(call))]
            junk[i] = (text.index("Item"), len(text))
    docs, found, wrong = docs_of(rows), 0, 0
    for r in pii.find(docs).collect():
        spans = [(k, int(s), int(e)) for k, s, e in (x.split(":") for x in r.spans.split(",") if x)]
        if r.doc_id in real:
            found += sum(x in spans for x in real[r.doc_id])
            wrong += sum(s >= junk[r.doc_id][0] for _, s, _ in spans)
    assert found >= 0.95 * 600
    assert wrong <= 0.01 * 600
