import random
import re
import string

from cohorta.llm.secret_scan import find_secrets, train
from tests.llm.odd import EXTRA, SCHEMA, odd_rows, row, with_extra

KEYWORD = "|".join("".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in k) for k in ("password", "passwd", "secret", "token", "api_?key"))
ASSIGN = re.compile(rf"""(?:{KEYWORD})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def brute(text):
    text = text or ""
    found = [(m.start(), 0, f"assign:{m.start()}:{m.end()}") for m in ASSIGN.finditer(text) if len(m[1]) >= 6]
    found += [(m.start(), 1, f"access:{m.start()}:{m.end()}") for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, f"hex:{m.start()}:{m.end()}") for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return [s for _, _, s in sorted(found)]


def key(rng, n=32):
    return "".join(rng.choice(string.ascii_letters + string.digits) for _ in range(n))


def fixture():
    rng = random.Random(9)
    rows = odd_rows()
    for i in range(120):
        name = "_".join(rng.choice(("user", "config", "value", "handler", "request", "account")) for _ in range(4))
        texts = [
            f"é😀 Password: \"{key(rng, rng.randint(4, 30))}\" and {name}",
            f"api_key='{key(rng)}' token=token=ab",
            f"AKIA{''.join(rng.choice(string.ascii_uppercase) for _ in range(rng.randint(10, 20)))}AKIA {name}",
            "".join(rng.choice("0123456789abcdef") for _ in range(rng.randint(20, 50))) + "g",
            f"secret:token:abcdefgh ſecret=abcdefgh TOKEN=abcdefgh {name}{name}",
        ]
        rows.append(row(100 + i, texts[i % 5]))
    return rows


def test_base_spans_against_brute_force(spark):
    rows = fixture()
    docs = spark.createDataFrame(with_extra([r for r in rows]), f"{SCHEMA}, {EXTRA}").repartition(3)
    got = find_secrets(docs, train(docs)).collect()
    assert len(got) == len(rows)
    for r in got:
        want = brute(r["text"])
        assert r["base_spans"] == want
        assert [r["n_assign"], r["n_access"], r["n_hex"]] == [sum(s.startswith(k) for s in want) for k in ("assign", "access", "hex")]
        assert [s for s in r["spans"] if not s.startswith("markov")] == want


def test_models_tell_random_strings_from_identifiers(spark):
    docs = spark.createDataFrame(fixture(), SCHEMA)
    model = train(docs)
    rng = random.Random(10)
    assert sum(model.is_secret(key(rng, 40)) for _ in range(50)) >= 45
    assert not any(model.is_secret(w) for w in ("request_handler_value_config", "account_user_account_user", "internationalisation"))
    text = f"left {key(rng, 40)} right"
    (r,) = find_secrets(spark.createDataFrame([(1, text)], "doc_id int, text string"), model).collect()
    assert r["spans"] == ["markov:5:45"] and r["base_spans"] == []


def test_nothing_to_learn_from(spark):
    docs = spark.createDataFrame([], SCHEMA)
    model = train(docs)
    assert find_secrets(docs, model).count() == 0
    (r,) = find_secrets(spark.createDataFrame([(1, None)], "doc_id int, text string"), model).collect()
    assert r["spans"] == [] and r["n_hex"] == 0
