"""Share of re-parameterised questions that are found, by kind of change, and clean texts that are left alone."""

from __future__ import annotations

import random

from framewright.llm import decontaminate

NAMES = ["Tom", "Anna", "Mary Lou", "Peter van", "Rosa Maria Lopez", "Ivan", "Lee Ann", "Oscar"]
WORDS = ["two", "nine", "sixty", "twenty five", "three hundred", "forty-one", "twelve", "seven thousand"]
DIGITS = ["3", "17", "250", "4.5", "1,200", "88", "9", "61"]
NOUNS = ["miles", "kilometers", "apples", "furlongs", "sacks", "hours", "crates", "stones"]
FORMS = [
    "Yesterday {a} left the harbour with {x} {u} of rope and sold {y} {u} to {b} before the tide turned, so how much rope was left at night",
    "The baker {a} fills {x} {u} every morning while {b} empties {y} {u} every evening, and we ask after how many days the store is bare",
    "A train that {a} drives covers {x} {u} in the time that the cart of {b} covers {y} {u} along the same road, how far apart are they",
    "In the garden {a} planted {x} {u} in a row and {b} planted {y} {u} in the next row, how many plants does a visitor count there",
    "When {a} paid {x} {u} for the old boat the owner {b} gave back {y} {u} at once, what did the boat cost in the end of it",
]
PAD = "long before any of it began the keeper of the tower wrote down what the wind had done and nobody read it"


def _values(rng: random.Random, numbers: list[str], long_names: bool | None) -> dict[str, str]:
    names = [n for n in NAMES if long_names is None or (" " in n and "van" not in n) == long_names and "van" not in n]
    a, b = rng.sample(names, 2)
    x, y = rng.sample(numbers, 2)
    return {"a": a, "b": b, "x": x, "y": y, "u": rng.choice(NOUNS)}


KINDS = {
    "as it is": lambda rng, v: v,
    "other numbers": lambda rng, v: v | {k: _values(rng, DIGITS, False)[k] for k in "xy"},
    "other names": lambda rng, v: v | {k: _values(rng, DIGITS, False)[k] for k in "ab"},
    "other units": lambda rng, v: v | {"u": rng.choice(NOUNS)},
    "numbers in words": lambda rng, v: v | {k: _values(rng, WORDS, False)[k] for k in "xy"},
    "longer names": lambda rng, v: v | {k: _values(rng, DIGITS, True)[k] for k in "ab"},
    "all of it": lambda rng, v: _values(rng, WORDS, True),
    "without capitals": lambda rng, v: v,
    "in capitals": lambda rng, v: v,
}


def test_recall_by_kind(spark):
    rng = random.Random(7)
    items, docs, kinds = [], [], {}
    for i in range(40):
        form, v = FORMS[i % len(FORMS)], _values(rng, DIGITS, i % 3 == 0)
        # 40 questions of five forms: told apart by words of their own
        own = " ".join(rng.choice("abcdefgh") * 3 + rng.choice("stuvw") for _ in range(3))
        items.append((i, f"{form} {own}".format(**v)))
        for kind, change in KINDS.items():
            text = f"{form} {own}".format(**change(rng, v))
            text = text.lower() if kind == "without capitals" else text.upper() if kind == "in capitals" else text
            kinds[len(docs)] = (kind, i)
            docs.append((len(docs), f"{PAD[: rng.randrange(20, len(PAD))]}. {text}. {PAD}"))
    clean = len(docs)
    for i in range(200):
        v = _values(rng, DIGITS + WORDS, None)
        docs.append((len(docs), f"{PAD} {v['a']} saw {v['x']} {v['u']} near {v['b']} and {v['y']} {v['u']} of {' '.join(rng.sample(PAD.split(), 12))}"))
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontaminate.find_leaks(spark.createDataFrame(docs, "doc_id long, text string"), bench).collect()}
    recall = {k: sum((d, i) in got for d, (kind, i) in kinds.items() if kind == k) / 40 for k in KINDS}
    print(recall)
    assert min(recall.values()) >= 0.9, recall
    assert not [d for d, _ in got if d >= clean]


def test_slots_must_be_consistent_in_templates(spark):
    item = "Once Tom had 12 apples and gave 5 apples to Bob before he ate 12 more on the way home to the mill"
    said = {
        1: "Once Mary Lou had sixty pears and gave nine pears to Rosa before he ate sixty more on the way home to the mill",
        2: "Once Mary Lou had twenty five pears and gave 5 pears to Rosa before he ate twenty five more on the way home to the mill",
        3: "Once Tom had two thousand",
        4: "nothing of the kind",
    }
    docs = spark.createDataFrame([*said.items(), (5, None), (6, "")], "doc_id long, text string")
    got = {r.doc_id: (r.verbatim, r.matched == r.n_tokens) for r in decontaminate.find_leaks(docs, spark.createDataFrame([(0, item)], "item_id long, text string")).collect()}
    assert got == {1: (False, True), 2: (False, True)}
