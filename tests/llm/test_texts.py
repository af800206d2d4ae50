"""Toxicity, pseudonyms, licences and benchmark items."""

import random
import re

from tallyflow.llm import decontaminate, licenses, pii, toxicity
from tests.llm.data import awkward, documents, prose


# toxicity


def labelled(spark, n=600):
    rng = random.Random(6)
    rows, labels = [], []
    for k in range(n):
        bad = k % 5 == 0
        words = prose(rng, 40).split()
        if bad:
            words[rng.randrange(40)] = rng.choice(("zorkel", "zorkeling", "grumtik"))
        rows.append((k, " ".join(words)))
        labels.append((k, int(bad)))
    return documents(spark, rows), spark.createDataFrame(labels + [(None, 1), (3, None)], "doc_id long, toxic int")


def test_grammar_reads_clauses():
    m = toxicity.Model({"idiot": 5.0})
    read = lambda t: {k: v for k, v in enumerate(m.read(t)) if v}
    assert read("an idiot") == {1: 5.0}
    assert read("you idiot") == {2: 5.0}
    assert read("an idiot you are") == {2: 5.0}
    assert read("not an idiot") == {3: 5.0}
    assert read("he said what an idiot") == {5: 5.0}
    assert read("not here. an idiot") == {1: 5.0}  # a scope ends with its clause
    assert read("I will kill you") == {10: 1.0} and read("to kill time") == {9: 1.0}
    assert read("fine") == {} and read("") == {} and read("anidiot") == {}
    plain, told, aimed, threat = (m.score(m.read(t)) for t in ("an idiot", "he said an idiot", "you idiot", "kill you"))
    assert told < plain < aimed and threat > 0.3 > m.score(m.read("to kill time"))


def test_toxicity_learns_and_generalises(spark):
    docs, labels = labelled(spark)
    model = toxicity.train(docs, labels)
    out = toxicity.score(docs, model).collect()
    held = [r for r in out if r.held_out]
    assert held and all(r.predicted == int(r.doc_id % 5 == 0) for r in held) and all(0 <= r.score <= 1 for r in out)
    assert [r.doc_id for r in toxicity.accepted(docs, model).select("doc_id").orderBy("doc_id").collect()] == [k for k in range(600) if k % 5]
    assert toxicity.accepted(docs, model).columns == docs.columns


def test_held_out_labels_change_no_score(spark):
    from tallyflow.llm.frames import table

    docs, labels = table(spark, "/root/testdata/sf0.01", "documents"), table(spark, "/root/testdata/sf0.01", "labels")
    flipped = labels.selectExpr("doc_id", "quality", "if(crc32(cast(doc_id as string)) % 4 = 2, 1 - toxic, toxic) as toxic")
    a, b = toxicity.train(docs, labels), toxicity.train(docs, flipped)
    assert a.patterns == b.patterns and a.bias == b.bias and (a.weights == b.weights).all()


def test_accepted_rows_keep_their_columns(spark):
    from tallyflow.llm.frames import table

    docs = table(spark, "/root/testdata/sf0.001", "documents")
    model = toxicity.train(docs, table(spark, "/root/testdata/sf0.001", "labels"))
    want = {r.doc_id for r in toxicity.score(docs, model).where("predicted = 0").collect()}
    got = toxicity.accepted(docs, model)
    assert got.schema == docs.schema and {r.doc_id for r in got.collect()} == want


def test_toxicity_of_awkward_rows(spark):
    docs, labels = labelled(spark)
    rows = awkward()
    model = toxicity.train(documents(spark, rows), labels.where("toxic is null"))  # nothing to learn from
    out = toxicity.score(documents(spark, rows), model)
    assert out.count() == len(rows) and out.where("score is null or held_out is null or predicted <> 0").count() == 0
    assert toxicity.score(documents(spark, []), toxicity.train(documents(spark, []), labels)).count() == 0
    assert toxicity.accepted(documents(spark, rows), model).count() == len(rows)


# pseudonyms


def luhn(s):
    d = [int(c) for c in re.sub(r"\D", "", s)][::-1]
    return sum(x if k % 2 == 0 else (2 * x - 9 if x > 4 else 2 * x) for k, x in enumerate(d)) % 10 == 0


def test_pseudonyms_keep_formats_and_links(spark):
    texts = [
        "call +1 (017) 555-7713 now", "or +1 017 555 7713.", "card 4041894974608795 and 4041-8949-7460-8795", "und.34@mail7.example.com", "host 42.144.35.254, not 300.1.2.3",
        'token = "b44e15e09fd311c3cf3163b66d5a9875b883d8ce" y', "born 1987-02-28, 31.02.2000 28.02.1987 02/30/2000", "DE89370400440532013000 DE89 3704 0044 0532 0130 00 DE89370400440532013001",
        "123-45-6789", "number 1234567890123456 only", "", None, "nothing here", "$1 \\1 50%",
    ]
    out = {r.doc_id: r for r in pii.pseudonymized(documents(spark, list(enumerate(texts))), "key").collect()}
    new = [out[k].text for k in range(len(texts))]
    digits = lambda s: re.sub(r"\D", "", s)
    assert re.fullmatch(r"call \+1 \(\d{3}\) \d{3}-\d{4} now", new[0]) and digits(new[0]) == digits(new[1]) != digits(texts[0])
    a, b = re.findall(r"[\d-]{16,}", new[2])
    assert luhn(a) and digits(a) == digits(b) and a != "4041894974608795"
    assert re.fullmatch(r"[a-z]{3}\.\d\d@mail7\.example\.com", new[3]) and new[3] != texts[3]
    ip = re.match(r"host ([\d.]+), not 300.1.2.3", new[4])[1]
    assert ip != "42.144.35.254" and all(int(x) < 256 for x in ip.split("."))
    assert re.fullmatch(r'token = "[0-9a-f]{40}" y', new[5]) and new[5] != texts[5]
    iso, bad, dotted, never = re.match(r"born (\S+), (\S+) (\S+) (\S+)", new[6]).groups()
    assert (bad, never) == ("31.02.2000", "02/30/2000") and iso.split("-") == dotted.split(".")[::-1] and iso != "1987-02-28"
    x, y, z = re.match(r"(\S+) (.+?) (DE89370400440532013001)", new[7]).groups()
    assert x == y.replace(" ", "") != "DE89370400440532013000" and int("".join(str(int(c, 36)) for c in x[4:] + x[:4])) % 97 == 1
    assert re.fullmatch(r"\d{3}-\d\d-\d{4}", new[8]) and new[8] != texts[8]
    assert new[9:] == texts[9:]
    assert [out[k].n_found for k in range(len(texts))] == [1, 1, 2, 1, 1, 1, 2, 2, 1, 0, 0, 0, 0, 0]
    assert (out[2].n_card, out[6].n_date, out[7].n_iban) == (2, 2, 2)


def test_cards_and_accounts_beside_other_numbers_and_words(spark):
    card, spaced, iban = "4111111111111111", "4111 1111 1111 1111", "ES9121000418450200051332"
    texts = [
        card, f"{card} 12/27", f"{spaced} 123", f"order 12 {card}", f"12 34 56 78 {spaced} 99 {card} 7", f"{spaced}-{spaced}", f"{card} 12abc", f"REF AB12 {card}", f"DE12 {card} 12",
        iban, f"{iban} EUR", "ES91 2100 0418 4502 0005 1332 EUR AB", "BE68539007547034 EUR", f"{iban} {spaced}", f"{spaced} 123-45-6789", f"{card} 192.168.1.1", f"{spaced} 12/27/1990", f"5 6 7 8 9 {card} 1987-02-28",
    ]
    out = {r.doc_id: r for r in pii.pseudonymized(documents(spark, list(enumerate(texts))), "key").collect()}
    new = [out[k].text for k in range(len(texts))]
    for old, text in zip(texts, new):
        assert re.sub("[0-9]+", "0", text) == re.sub("[0-9]+", "0", old)
        assert not any(x in text.replace(" ", "") for x in (card, iban, "BE68539007547034", "123-45-6789", "192.168.1.1", "12/27/1990", "1987-02-28")), text
    c = new[0]
    grouped = " ".join(re.findall("....", c))
    assert luhn(c) and c != card
    assert new[1:9] == [f"{c} 12/27", f"{grouped} 123", f"order 12 {c}", f"12 34 56 78 {grouped} 99 {c} 7", f"{grouped}-{grouped}", f"{c} 12abc", f"REF AB12 {c}", f"DE12 {c} 12"]
    assert new[10] == f"{new[9]} EUR" and new[11] == " ".join(re.findall("....", new[9])) + " EUR AB" and new[13] == f"{new[9]} {grouped}"
    assert [out[k].n_card for k in range(len(texts))] == [1, 1, 1, 1, 2, 2, 1, 1, 1, 0, 0, 0, 0, 1, 1, 1, 1, 1]
    assert [out[k].n_found for k in range(9, len(texts))] == [1, 1, 1, 1, 2, 2, 2, 2, 2]
    long = "1 23 456 7890 " * 20_000
    assert len(pii.pseudonymized(documents(spark, [(0, long + card)]), "key").first().text) == len(long) + 16


def test_dates_with_the_day_first(spark):
    texts = ["25/12/1987 31/01/1990", "1987-12-25 1990-01-31", "12/25/1987 01/31/1990", "25.12.1987 31.01.1990", "05/06/1990", "1990-05-06", "31/02/1990 13/13/1990"]
    out = {r.doc_id: r for r in pii.pseudonymized(documents(spark, list(enumerate(texts))), "key").collect()}
    read = lambda k, order: [tuple(re.split(r"\D", d)[p] for p in order) for d in out[k].text.split()]
    assert read(0, (2, 1, 0)) == read(1, (0, 1, 2)) == read(2, (2, 0, 1)) == read(3, (2, 1, 0)) != [("1987", "12", "25"), ("1990", "01", "31")]
    assert all(int(day) > 12 for _, _, day in read(0, (2, 1, 0)))
    assert read(4, (2, 0, 1)) == read(5, (0, 1, 2)) and out[4].text != texts[4] and out[6].text == texts[6]
    assert [out[k].n_date for k in range(7)] == [2, 2, 2, 2, 1, 1, 0]


def test_keys_of_any_length(spark):
    body = "aB3" * 60
    keys = ["sk-" + body[:129], "ghp_" + body, "sk-proj-" + body + "_" + body[:150], "pk-" + body * 500]
    out = {r.doc_id: r for r in pii.pseudonymized(documents(spark, [(k, f"key {t}, end") for k, t in enumerate(keys)]), "key").collect()}
    for k, t in enumerate(keys):
        new = re.fullmatch(r"key ([\w-]+), end", out[k].text)[1]
        assert out[k].n_secret == 1 and len(new) == len(t) and new[:3] == t[:3] and all(new[p : p + 60] != t[p : p + 60] for p in range(4, len(t) - 60, 60))


def test_days_of_two_centuries_stay_apart(spark):
    from pyspark.sql import functions as F

    days = spark.sql("select explode(sequence(date '1900-01-01', date '2099-12-31')) d").repartition(8)
    moved = days.select(F.date_format("d", "yyyy-MM-dd").alias("s"), "d").select("d", pii._date(F.col("s"), "k").alias("p"))
    assert moved.select("p").distinct().count() == 73_049 == moved.where("p between '1900-01-01' and '2099-12-31' and (day(p) > 12) = (day(d) > 12)").count()


def test_pseudonyms_are_a_bijection(spark):
    from pyspark.sql import functions as F

    numbers = spark.range(10_000).select(F.lpad(F.col("id").cast("string"), 4, "0").alias("s"))
    assert numbers.select(pii.feistel_text(F.col("s"), "k", "t").alias("p")).where("p rlike '^[0-9]{4}$'").distinct().count() == 10_000
    days = spark.sql("select explode(sequence(date '1999-01-01', date '2003-12-31')) d").selectExpr("date_format(d, 'yyyy-MM-dd') s")
    moved = days.select(pii._date(F.col("s"), "k").alias("p"))
    assert moved.distinct().count() == days.count() and moved.where("p between '1900-01-01' and '2099-12-31'").count() == days.count()


def test_letters_of_all_scripts_and_national_forms(spark):
    hexed = "0123456789abcdef" * 9
    texts = [
        "иван@example.com, élodie@example.fr", "联系我zhang@example.com 用户@例子.广告", "--" + "x1y" * 40 + "@example.org", f"{hexed} {hexed.upper()}", "aB3D" * 10, "ruf 0171 2345678 an", "06 12 34 56 78 ou 06.12.34.56.78", "eyJhbGciOiJI.eyJzdWIiOiIx.SflKxwRJSMeKKF2Q",
        "password: hunter22secret. next", "Mot de passe = 'Sesam1234'", "at 2001:db8::8a2e:370:7334 and 2001:0DB8:0:0:0:8a2e:0370:7334.", "3/4/1987 and 03/04/1987, 5.6.1990", "de89 3704 0044 0532 0130 00 DE89370400440532013000", "teléfono 612 345 678",
    ]
    out = {r.doc_id: r for r in pii.pseudonymized(documents(spark, list(enumerate(texts))), "key").collect()}
    new = [out[k].text for k in range(len(texts))]
    assert [out[k].n_found for k in range(len(texts))] == [2, 2, 1, 2, 1, 1, 2, 1, 1, 1, 2, 3, 2, 1]
    a, b = re.fullmatch(r"([\u0400-\u04ff]{4})@example\.com, (\S{6})@example\.fr", new[0]).groups()
    assert a != "иван" and b[0] != "é" and b[0] > "\x7f" and b[0].islower() and not set("lodie") >= set(b[1:])
    assert re.fullmatch(r"联系我[a-z]{5}@example\.com [一-鿿]{2}@例子\.广告", new[1]) and "zhang" not in new[1] and "用户" not in new[1]
    assert re.fullmatch(r"--(?:[a-z]\d[a-z]){40}@example\.org", new[2]) and "x1yx1y" not in new[2]
    low, high = new[3].split()
    assert high == low.upper() and len(low) == 144 and low != hexed and re.fullmatch("[0-9a-f]+", low)
    assert re.fullmatch(r"(?:[a-f][A-F]\d[A-F]){10}", new[4]) and new[4] != texts[4]
    assert re.fullmatch(r"ruf \d{4} \d{7} an", new[5]) and new[5] != texts[5]
    x, y = new[6].split(" ou ")
    assert x.replace(" ", ".") == y != "06.12.34.56.78" and re.fullmatch(r"\d\d(\.\d\d){4}", y)
    assert re.fullmatch(r"eyJ\w{9}\.\w{12}\.\w{16}", new[7]) and new[7] != texts[7]
    assert re.fullmatch(r"password: [a-z]{6}\d\d[a-z]{6}\. next", new[8]) and "hunter" not in new[8]
    assert re.fullmatch(r"Mot de passe = '[A-Z][a-z]{4}\d{4}'", new[9]) and "Sesam" not in new[9]
    v, w = re.fullmatch(r"at (\S+) and (\S+)\.", new[10]).groups()
    assert v == w and re.fullmatch(r"2001(?::[0-9a-f]{4}){7}", v) and "370:7334" not in v
    s, t, u = re.split(",? (?:and )?", new[11])
    assert [int(p) for p in s.split("/")] == [int(p) for p in t.split("/")] != [3, 4, 1987] and len(t) == 10 and u != "5.6.1990"
    m, n = new[12][:27], new[12][28:]
    assert m.replace(" ", "").upper() == n != "DE89370400440532013000" and m == m.lower()
    assert re.fullmatch(r"teléfono \d{3} \d{3} \d{3}", new[13]) and new[13] != texts[13]
    clean = ["std::vector a::b 12:30:45 at 3:4", "password: required", "1 051 240 000 of 2 612 345", "version 1.2.3, 10.000.000", "the secret: a good night's sleep", "tel aviv 2019", "x" * 300_000 + " 1", "a-" * 100_000 + " 1"]
    assert [r.text for r in pii.pseudonymized(documents(spark, list(enumerate(clean))), "key").orderBy("doc_id").collect()] == clean


def test_letters_beyond_ascii_are_a_bijection(spark):
    from pyspark.sql import functions as F

    letters = "".join(chr(c) for c in range(0x430, 0x450))
    words = spark.createDataFrame([(a + b,) for a in letters for b in letters], "s string")
    moved = words.repartition(8).select(pii.feistel_text(F.col("s"), "k", "t").alias("p"))
    assert moved.distinct().count() == len(letters) ** 2 == moved.where(r"p rlike '^\\p{Ll}{2}$'").count()


def test_clashing_names_and_the_key(spark):
    df = spark.createDataFrame([(1, "mail a.b@example.com", "mine", "yours", 3)], "doc_id long, text string, _text string, _made string, made_ int")
    r = pii.cleaned(df, "k").first()
    assert (r["_text"], r["_made"], r["made_"]) == ("mine", "yours", 3) and r.text != "mail a.b@example.com"
    name = "spark.llm.pii.testkey"
    key = pii.key_of(spark, name)
    assert len(key) == 64 and pii.key_of(spark, name) == key
    spark.conf.unset(name)


def test_pseudonyms_of_awkward_rows(spark):
    rows = awkward()
    df = documents(spark, rows)
    out = pii.cleaned(df, "k")
    assert out.columns == df.columns and sorted(map(repr, out.collect())) == sorted(map(repr, df.collect()))
    assert pii.pseudonymized(documents(spark, []), "k").count() == 0
    plan = pii.pseudonymized(df, "k")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


# licences


def test_licences_and_their_folders(spark):
    mit, gpl = "Released under the MIT License.", "This work is licensed under the GNU General Public License, version 3."
    rows = [
        (1, "a/LICENSE", mit), (2, "a/b/c.py", "x = 1"), (3, "a/b/COPYING", gpl), (4, "a/b/d/e.py", "# Licensed under the Apache License, Version 2.0\n" + "x = 1\n" * 50),
        (5, "a/b/d/f.py", ""), (6, "g.py", None), (7, None, mit), (8, None, "x"), (None, "a/z.py", "the thing"), (9, "LICENSE.txt", "blah"), (10, "q/r.py", "SPDX-License-Identifier: MIT"),
        (11, "t/LICENSE", mit), (11, "t/LICENSE", mit), (12, "t/COPYING", gpl), (13, "t/u", "x"), (14, "a/long.py", "word " * 20_000 + "\n" + gpl),
    ]
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], "id long, path string, text string, license int, score int")
    got = {(r.id, r.path): (r.license, r.origin) for r in licenses.scan(df).collect()}
    assert got == {
        (1, "a/LICENSE"): ("MIT", "declared"), (2, "a/b/c.py"): ("GPL-3.0", "inherited"), (3, "a/b/COPYING"): ("GPL-3.0", "declared"), (4, "a/b/d/e.py"): ("Apache-2.0", "declared"),
        (5, "a/b/d/f.py"): ("GPL-3.0", "inherited"), (6, "g.py"): (None, "none"), (7, None): ("MIT", "declared"), (8, None): (None, "none"), (None, "a/z.py"): ("MIT", "inherited"),
        (9, "LICENSE.txt"): (None, "none"), (10, "q/r.py"): ("MIT", "declared"), (11, "t/LICENSE"): ("MIT", "declared"), (12, "t/COPYING"): ("GPL-3.0", "declared"),
        (13, "t/u"): ("GPL-3.0", "inherited"), (14, "a/long.py"): ("GPL-3.0", "declared"),
    }
    assert licenses.scan(df).count() == len(rows) and licenses.scan(df.limit(0)).count() == 0


def test_denials_and_rows_of_one_name(spark):
    mit, gpl = "Released under the MIT License.", "This work is licensed under the GNU General Public License, version 3."
    rows = [(1, "a/x.py", "This file is not licensed under the MIT license."), (2, "b/x.py", f"It is not licensed under the MIT license.\n\n{gpl}"), (3, "c/x.py", mit), (3, "c/x.py", gpl)]
    rows += [(k, f"d/{k}.py", mit) for k in range(10, 210)]
    got = sorted((r.id, r.license or "") for r in licenses.scan(spark.createDataFrame(rows, "id long, path string, text string")).collect())
    assert got == [(1, ""), (2, "GPL-3.0"), (3, "GPL-3.0"), (3, "MIT"), *[(k, "MIT") for k in range(10, 210)]]


def test_wrapped_headers_and_licence_files(spark):
    import textwrap

    gnu = "This {0} is free software{3} you can redistribute it and/or modify it under the terms of the GNU {1} as published by the Free Software Foundation{4} either version {2} of the License, or (at your option) any later version."
    more = "This {0} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the GNU {1} for more details."
    kinds = [("GPL-3.0", "program", "General Public License", "3", ":", ","), ("GPL-2.0", "program", "General Public License", "2", ";", ";"), ("LGPL-2.1", "library", "Lesser General Public License", "2.1", ";", ";"),
             ("LGPL-3.0", "library", "Lesser General Public License", "3", ":", ","), ("AGPL-3.0", "program", "Affero General Public License", "3", ":", ",")]
    full = dict((name, max((t for n, t in licenses.TEMPLATES if n == name), key=len)) for name in ("MIT", "BSD-2-Clause", "BSD-3-Clause", "ISC", "Unlicense", "Apache-2.0"))
    wrap = lambda t, mark="", width=72: "\n".join(mark + x for x in textwrap.wrap(t, width))
    rows = []
    for name, what, title, version, a, b in kinds:
        one, two = gnu.format(what, title, version, a, b), more.format(what, title)
        rows.append((name, f"{wrap(one)}\n\n{wrap(two)}\n"))
        rows.append((name, f"# Copyright (C) 2020 Jane Doe\n#\n{wrap(one, '# ')}\n#\n{wrap(two, '# ')}\nimport os\n" + "x = 1\n" * 40))
        rows.append((name, f"/*\n{wrap(one, ' * ')}\n *\n{wrap(two, ' * ')}\n */\nint x;\n" + "f(x);\n" * 40))
    for name, text in full.items():
        rows += [(name, "Copyright (c) 2021, Jane Doe\n" + wrap(text)), (name, f"{wrap(text, '// ', 60)}\nint main() {{}}\n")]
    df = spark.createDataFrame([(k, f"d{k}/src/f{k}", text) for k, (_, text) in enumerate(rows)], "id long, path string, text string")
    assert {r.id: r.license for r in licenses.scan(df).collect()} == {k: name for k, (name, _) in enumerate(rows)}


# benchmark items


def brute_items(rows, items):
    words = lambda t: [w for w in re.split(r"[\W_]+", (t or "").lower()) if w]
    out = []
    for j, x in items:
        v = words(x)
        k = min(5, len(v))
        own = {tuple(v[i : i + k]) for i in range(len(v) - k + 1)} if v else set()
        for i, t in rows:
            w = words(t)
            held = {tuple(w[p : p + k]) for p in range(len(w) - k + 1)} if k else set()
            if i is not None and j is not None and own and len(own & held) >= 0.75 * len(own):
                out.append((i, j, len(own), len(own & held)))
    return sorted(set(out))


def test_items_inside_documents(spark, monkeypatch):
    rng = random.Random(9)
    items = [(k, prose(rng, rng.choice((3, 8, 16, 40, 90)))) for k in range(30)] + [(40, None), (41, ""), (42, "one"), (None, "null id here now then"), (43, prose(rng, 16))]
    rows = awkward()
    for k, t in items[:30]:
        w = t.split()
        cut = rng.randrange(len(w) // 3 + 1)
        rows.append((500 + k, prose(rng, 300) + " " + " ".join(w[cut:]).upper() + "!! " + prose(rng, 500)))
    items.append((43, items[-1][1]))
    df = documents(spark, rows)
    bench = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, members int")
    want = brute_items(rows, items)
    assert len(want) > 10
    for block in (decontaminate.BLOCK, 8):  # one broadcast, or many blocks
        monkeypatch.setattr(decontaminate, "BLOCK", block)
        assert sorted(tuple(r)[:4] for r in decontaminate.contaminated(df, bench).collect()) == want
    clean = decontaminate.clean(df, bench)
    dirty = {x[0] for x in want}
    assert clean.columns == df.columns and sorted(map(repr, clean.collect())) == sorted(repr(r) for r in df.collect() if r.doc_id not in dirty)
    assert decontaminate.contaminated(df.limit(0), bench).count() == 0 and decontaminate.contaminated(df, bench.limit(0)).count() == 0
    assert decontaminate.clean(df, bench.limit(0)).count() == len(rows)
