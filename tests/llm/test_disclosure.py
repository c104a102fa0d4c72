"""Disclosure of protected entities by terms, against a plain count over all texts."""

import math
import random
import re

import pytest
from pyspark.sql import functions as F

from olapkit.llm import personal_data as pd
from olapkit.llm.queries import QUERIES

WORDS = re.compile(r"[^\W_]+")


def words_of(text):
    return set(WORDS.findall(text.lower()))


def prose(rng, n):
    return " ".join("".join(rng.choice("abcdef") for _ in range(rng.randint(2, 4))) for _ in range(n))


@pytest.fixture(scope="module")
def texts():
    """Mail domains with words of their own, a network with a nickname, a word only texts with cards have, and copies."""
    rng, out = random.Random(4), []
    for i in range(12):
        out.append(f"{prose(rng, 40)} Orbex{i % 3} desk: user{i}@dom{i % 3}.org {prose(rng, 30)} {'orbex0' if i == 1 else ''}")
    for i in range(10):
        out.append(f"{prose(rng, 30)} host 10.20.{i % 2}.{i} lies in Zumtal{i % 2} {prose(rng, 20)}")
    for i in range(9):
        out.append(f"pay KARTEX by 4111 1111 1111 1111 {prose(rng, 30)} or call +1 706 555 31{i}8")
    out += [prose(rng, 60) for _ in range(250)]
    out += [out[0]] * 40 + [out[12]] * 3 + ["", None, "KARTEX alone" if False else prose(rng, 5)]
    return out


def entities_of(spans, text):
    out = set()
    for kind, a, b in spans:
        m = text[a:b].lower()
        d = re.sub("[^0-9]", "", m)
        out.add(f"kind:{kind}")
        if kind == "email":
            name, domain = m.split("@")
            out |= {f"email:{m}", f"mail domain:{domain}", f"mail name:{name}"}
        elif kind == "ip":
            out |= {f"ip:{m}", f"network:{m.rsplit('.', 1)[0]}"}
        elif kind == "card":
            out |= {f"card:{d}", f"issuer:{d[:6]}"}
        else:
            out |= {f"phone:{d}", f"dialling code:{d[:4]}"}
    return out


def disclosed(rows):
    """(entity, term) pairs, and per text its spans, from the base spans of each different text."""
    n = len(rows)
    held, inside, everywhere = {}, {}, {}
    for text, spans in rows.items():
        blank = text
        for _, a, b in spans:
            blank = blank[:a] + " " * (b - a) + blank[b:]
        held[text] = entities_of(spans, text)
        inside[text] = words_of(blank) if spans else set()
        for w in words_of(text):
            everywhere[w] = everywhere.get(w, 0) + 1
    tried = sum(len(held[t]) * len(inside[t]) for t in rows)
    n_e, n_te = {}, {}
    for t in rows:
        for e in held[t]:
            n_e[e] = n_e.get(e, 0) + 1
            for w in inside[t]:
                n_te[e, w] = n_te.get((e, w), 0) + 1
    found = {}
    for (e, w), both in n_te.items():
        if 1 < n_e[e] < n:
            bits = math.log2(both * n / (everywhere[w] * n_e[e]))
            told = bits / math.log2(n / n_e[e])
            if both * bits > math.log2(max(n, tried, 1)) and told >= pd.GENERALISE:
                found[e, w] = told
    return found, held


@pytest.mark.parametrize("limit", [1 << 18, 0], ids=["terms sent", "texts shuffled"])
def test_disclosing_terms_are_brute_force(spark, texts, tmp_path, monkeypatch, limit):
    monkeypatch.setattr(pd, "BROADCAST_TERMS", limit)
    spark.createDataFrame(list(enumerate(texts)), "doc_id BIGINT, text STRING").repartition(5).write.parquet(f"{tmp_path}/documents.parquet")
    got = {r["doc_id"]: r for r in QUERIES["op9_personal_data"](spark, str(tmp_path)).collect()}
    rows = {}
    for i, t in enumerate(texts):
        listed = [s.split(":") for s in got[i]["spans"].split(",") if s]
        rows[t or ""] = [(k, int(a), int(b)) for k, a, b in listed if k != "term"]
    found, held = disclosed(rows)
    terms = {w for _, w in found}
    assert {"orbex1", "orbex2", "zumtal0", "zumtal1", "kartex"} <= terms
    total = 0
    for i, t in enumerate(texts):
        t = t or ""
        mine = {w for e, w in found if e in held[t]}
        base = rows[t]
        want = sorted(
            (m.start(), m.end())
            for m in WORDS.finditer(t)
            if m.group().lower() in mine and not any(a < m.end() and m.start() < b for _, a, b in base)
        )
        spans = [s.split(":") for s in got[i]["spans"].split(",") if s.startswith("term:")]
        assert sorted((int(a), int(b)) for _, a, b in spans) == want, t
        assert got[i]["n_terms"] == len(want)
        total += len(want)
    assert total > 60


def test_sanitising_keeps_columns_whatever_their_names(spark):
    rows = [(1, "mail me at a@b.org now", "x", "y", 3), (2, None, "x", "y", 4)]
    df = spark.createDataFrame(rows, "doc_id BIGINT, text STRING, _sanitised_text STRING, `row.text` STRING, key INT")
    out = pd.sanitise(df)
    assert out.columns == df.columns
    assert {tuple(r) for r in out.collect()} == {(1, "mail me at [EMAIL] now", "x", "y", 3), (2, None, "x", "y", 4)}


def test_terms_are_added_on_the_given_tables(spark):
    done = QUERIES["op9_personal_data"](spark, "/root/testdata/sf0.01")
    assert done.agg(F.sum("n_terms")).first()[0] >= 0
