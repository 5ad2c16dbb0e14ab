"""More different names than there are short surrogates."""

from verdigrid.llm.pii import replace_pii

LETTERS = "abcdefghijklmnopqrstuvwxyz"


def test_more_than_five_thousand_surnames(spark):
    names = ["X" + "".join(LETTERS[i // 26**k % 26] for k in range(3)) for i in range(5500)]
    docs = spark.createDataFrame([(i, f"Yesterday Mr {n} met them.") for i, n in enumerate(names)], "doc_id long, text string")
    rows = replace_pii(docs, "test-key").collect()
    assert len(rows) == 5500 and all(r["n_replaced"] == 1 for r in rows)
    new = [r["text"].split("Mr ")[1].split(" met")[0] for r in rows]
    assert len(set(new)) == 5500 and not set(new) & set(names)
    assert all(n.isalpha() and n == n.capitalize() for n in new)


def test_every_address_of_one_letter(spark):
    addresses = [f"{a}@{b}.de" for a in LETTERS for b in LETTERS]
    texts = [f"Write to {a} or {a.upper()} today." for a in addresses]
    rows = replace_pii(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), "test-key").collect()
    new = [r["text"].removeprefix("Write to ").removesuffix(" today.").split(" or ") for r in rows]
    assert len(rows) == 676 and all(r["n_replaced"] == 2 for r in rows)
    assert all(left.lower() == right.lower() and left.endswith(".de") and right.endswith(".DE") for left, right in new)
    assert len({left for left, _ in new}) == 676 and not {left for left, _ in new} & set(addresses)
