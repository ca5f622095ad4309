"""PII surrogates and shard interleaving: properties over hard cases, and plans without Python."""

import re
import zlib
from collections import Counter, defaultdict

from cases import SMALL, empty, frame
from civicflow.llm import queries, sharding, surrogates
from civicflow.llm.stages import written

PEOPLE = [
    (1, "Mr. John Smith met Mrs Anna Smith. Mr Smith called +1 (017) 555-7713, or +1.017.555.7713."),
    (2, "Mail A.B@Example.org or a.b@example.org; card 4111 1111 1111 1111 or 4111111111111111."),
    (3, "From 10.0.0.1. to 10.0.0.2, not 300.1.1.1 or 1.2.3.4.5; SSN 123-45-6789, IBAN DE89 3704 0044 0532 0130 00."),
    (4, "Господин Иван Петров и Госпожа Петров; Frau Ångström-Öberg; Señora López"),
    (4, "Господин Иван Петров и Госпожа Петров; Frau Ångström-Öberg; Señora López"),
    (5, None), (6, ""), (7, "nothing at all @ here 12 34"), (8, "x@" * 3000 + "a" * 20_000), (None, "call +1 (017) 555-7713"),
]


def people(spark):
    return spark.createDataFrame(PEOPLE, "doc_id long, text string")


def test_kinds_formats_and_references(spark):
    got = defaultdict(list)
    for r in surrogates.replace(people(spark), "k").collect():
        got[r["doc_id"]].append(r)
    a = re.fullmatch(r"Mr\. (\w+) (\w+) met Mrs (\w+) (\w+)\. Mr (\w+) called (\+1 \(\d{3}\) \d{3}-\d{4}), or (\+1\.\d{3}\.\d{3}\.\d{4})\.", got[1][0]["text"])
    assert a and a[2] == a[4] == a[5] != "Smith" and a[1].endswith("o") and a[3].endswith("a")
    digits = re.sub(r"\D", "", a[6])
    assert digits == re.sub(r"\D", "", a[7]) != "10175557713"
    assert a[6] in got[None][0]["text"]
    b = re.fullmatch(r"Mail (\S+@\S+) or (\S+@\S+); card (\d{4} \d{4} \d{4} \d{4}) or (\d{16})\.", got[2][0]["text"])
    assert b and b[1] == b[2] and b[1].endswith(".org") and b[3].replace(" ", "") == b[4] != "4111111111111111"
    total = sum(d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(int(c) for c in reversed(b[4])))
    assert b[4][0] == "4" and total % 10 == 0  # a valid number gives a valid number
    c = got[3][0]["text"]
    assert re.search(r"From (\d+\.){3}\d+\. to (\d+\.){3}\d+, not 300\.1\.1\.1 or 1\.2\.3\.4\.5; SSN \d{3}-\d\d-\d{4}, IBAN DE\d\d( \d{4}){4} \d\d\.", c)
    assert "123-45-6789" not in c and "3704 0044" not in c
    assert got[4][0]["text"] == got[4][1]["text"]
    assert re.search(r"Господин [а-я]+ей ([а-я]+) и Госпожа ([а-я]+);", got[4][0]["text"], re.I)
    assert [got[i][0]["text"] for i in (5, 6, 7, 8)] == [t for _, t in PEOPLE[5:9]]


MORE = [
    (1, "John said Smith was Mr John Smith's son; Smithson and McJohn are not, JOHN is another word. Call John-Paul."),
    (2, "John Smith has no title here."),
    (3, "Write john.smith2@acme.co.uk, j.doe@acme.co.uk, JOHN.SMITH2@acme.co.uk and john.smith2@other.com."),
    (4, "Frau Smith and Mr Smith: Smith."),
]


def test_names_again_and_mail_formats(spark):
    got = {r["doc_id"]: r for r in surrogates.replace(spark.createDataFrame(MORE, "doc_id long, text string"), "k").collect()}
    a = re.fullmatch(r"(\w+) said (\w+) was Mr (\w+) (\w+)'s son; Smithson and McJohn are not, JOHN is another word\. Call John-Paul\.", got[1]["text"])
    assert a and a[1] == a[3] != "John" and a[2] == a[4] != "Smith" and got[1]["n_entities"] == 3
    assert got[2]["text"] == MORE[1][1] and got[2]["n_entities"] == 0
    m = re.fullmatch(r"Write ([a-z]{4}\.[a-z]{5}\d)@([a-z]{4}\.[a-z]{2}\.uk), ([a-z]\.[a-z]{3})@(\S+), (\S+)@(\S+) and ([a-z]{4}\.[a-z]{5}\d)@([a-z]{5}\.com)\.", got[3]["text"])
    assert m and m[2] == m[4] == m[6] != "acme.co.uk" and m[1] == m[5] and m[7] != m[1] and m[8] != "other.com"
    c = re.fullmatch(r"Frau (\w+) and Mr (\w+): (\w+)\.", got[4]["text"])
    assert c[1] == c[2] == c[3] == a[2]


def test_draws_end_when_a_name_space_is_full(spark, monkeypatch):
    """Two letters of each kind: 256 names of four syllables for 600 people, and 26 mailboxes of one letter for 300 addresses."""
    monkeypatch.setitem(surrogates._LETTERS, "latin", (["b", "c"], ["a", "e"]))
    names = [("family_latin", f"name{i}") for i in range(600)] + [("mailbox", f"{'abcdefghij'[i % 10]}@d{i}.com") for i in range(300)]
    written(spark.createDataFrame(names, "kind string, canonical string"), "entities")
    table = surrogates.surrogate_table(spark.createDataFrame(names, "kind string, canonical string"), "k").collect()
    assert len(table) == 900 and len({(r["kind"], r["surrogate"]) for r in table}) == 900


def test_a_kind_without_enough_values_ends(spark, monkeypatch):
    from pyspark.sql import functions as F
    import pytest
    monkeypatch.setattr(surrogates, "_draw", lambda kind, canonical, key, turn: F.lit("same"))
    monkeypatch.setattr(surrogates, "ROUNDS", 3)
    entities = written(spark.createDataFrame([("ssn", "1"), ("ssn", "2")], "kind string, canonical string"), "entities")
    with pytest.raises(ValueError):
        surrogates.surrogate_table(entities, "k")


def test_very_many_entities_in_one_text(spark):
    import time
    took = {}
    for n in (2_000, 20_000):
        text = " ".join(f"a{i}@b{i % 50}.com" for i in range(n)) + " end"
        start = time.time()
        r = surrogates.replace(spark.createDataFrame([(1, text)], "doc_id long, text string"), "k").first()
        took[n] = time.time() - start
        words = r["text"].split(" ")
        assert r["n_entities"] == n and len(words) == n + 1 and len(set(words)) == n + 1
    assert took[20_000] < 10 * took[2_000] + 20


def test_the_hint_leaves_no_entity_out(spark):
    from pyspark.sql import functions as F
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("text").unionByName(people(spark).select("text"))
    missed = docs.filter(~F.col("text").rlike(surrogates.HINT) & (F.size(F.regexp_extract_all("text", F.lit(surrogates.PATTERN), F.lit(0))) > 0))
    assert missed.count() == 0


def test_other_key_other_surrogates(spark):
    one, two, again = ([r["text"] for r in surrogates.replace(people(spark).filter("doc_id < 4"), k).orderBy("doc_id").collect()] for k in "aba")
    assert one == again and all(x != y for x, y in zip(one, two))


def test_collisions_are_drawn_again(spark, monkeypatch):
    """With draws that mostly collide, and one that is a real entity, all surrogates are distinct and none is real."""
    from pyspark.sql import functions as F

    def few(kind, canonical, key, turn):
        return F.concat(F.lit("s"), F.pmod(F.xxhash64(canonical, F.lit(turn)), F.lit(40)).cast("string"))

    monkeypatch.setattr(surrogates, "_draw", few)
    entities = spark.createDataFrame([("email", f"s{i}") for i in range(3)] + [("email", f"e{i}") for i in range(20)], "kind string, canonical string")
    written(entities, "entities")  # sets the shared folder
    table = surrogates.surrogate_table(entities, "k").collect()
    assert sorted(r["canonical"] for r in table) == sorted(r["canonical"] for r in entities.collect())
    drawn = [r["surrogate"] for r in table]
    assert len(set(drawn)) == len(drawn) and not set(drawn) & {"s0", "s1", "s2"}


def test_surrogates_leave_nothing_and_keep_distinct(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = {r["doc_id"]: r for r in queries.QUERIES["op4_pii_surrogates"](spark, "/root/testdata/sf0.01").collect()}
    pattern = re.compile(r"[\w.]+@[\w.]+\.com|\+1 \(\d{3}\) \d{3}-\d{4}|(?<!\w)\d{16}(?!\w)|(?<![\w.])(?:\d{1,3}\.){3}\d{1,3}(?![\w])")
    there, back = {}, {}
    n = 0
    for d in docs.collect():
        before, after = pattern.findall(d["text"]), pattern.findall(found[d["doc_id"]]["text"])
        assert len(before) == len(after)
        for x, y in zip(before, after):
            n += 1
            assert x != y and there.setdefault(x.lower(), y.lower()) == y.lower() and back.setdefault(y.lower(), x.lower()) == x.lower()
        if not before:
            assert found[d["doc_id"]]["text"] == d["text"]
    assert n > 50 and not set(back) & set(there)


def test_surrogates_clashing_columns_and_empty(spark):
    docs = people(spark).selectExpr("doc_id", "text", "1 as row", "2 as e", "3 as kind", "4 as N_Entities", "5 as `a.b`")
    got = surrogates.replace(docs, "k")
    assert got.columns == ["doc_id", "row", "e", "kind", "a.b", "text", "n_entities"]
    assert got.count() == len(PEOPLE)
    assert surrogates.replace(people(spark).limit(0), "k").count() == 0


def plan(df):
    return df._jdf.queryExecution().toString()


def test_native_plans(spark):
    for name in ("op4_pii_surrogates", "op5_stratified_shards"):
        text = plan(queries.QUERIES[name](spark, SMALL))
        assert not re.search("Python|Pandas|Arrow|Cartesian|NestedLoop", text)


def test_shards(spark):
    docs = frame(spark)
    got = sharding.assign(docs, 4).collect()
    assert len(got) == docs.count()
    per = Counter(r["shard"] for r in got)
    assert max(per.values()) - min(per.values()) <= 1 and set(per) == set(range(4))
    for s in range(4):
        assert sorted(r["slot"] for r in got if r["shard"] == s) == list(range(per[s]))
        for source in ("a", "b", None):
            share = sum(r["source"] == source for r in got) / 4
            assert abs(sum(r["source"] == source and r["shard"] == s for r in got) - share) <= 2
    for r in got:
        raw = (r["text"] or "").encode()
        assert (r["size"], r["text_crc32"]) == (len(raw) + 1, zlib.crc32(raw))
    assert sharding.assign(empty(spark), 4).count() == 0
    assert sharding.assign(docs.limit(3), 16).count() == 3


def brute_shards(rows, shards):
    """The same order by plain sorting: rank within source by hash, then fractional ranks."""
    sources = defaultdict(list)
    for h, s, i in rows:
        sources[s].append((h, i))
    order = []
    for s, members in sources.items():
        members.sort()
        order += [((k + 0.5) / len(members), s, h, i) for k, (h, i) in enumerate(members)]
    order.sort()
    return {i: p * shards // len(order) for p, (_, _, _, i) in enumerate(order)}


def test_shards_equal_a_plain_sort(spark):
    from pyspark.sql import functions as F
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    got = {r["doc_id"]: r["shard"] for r in sharding.assign(docs, 16).collect()}
    crc = F.crc32(F.col("text").cast("binary"))
    hashed = docs.select("doc_id", "source", F.xxhash64(F.lit(42), F.col("doc_id").cast("string"), crc,
                                                        F.octet_length("text").cast("long") + 1).alias("h")).collect()
    rows = [((r["h"] % (1 << 64)) >> 33, "s:" + r["source"], r["doc_id"]) for r in hashed]
    assert got == brute_shards(rows, 16)


def test_a_third_of_equal_rows_is_dealt_over_the_source(spark):
    from pyspark.sql import functions as F
    rows = spark.range(0, 6000, 1, 6).select(
        F.when(F.col("id") % 3 == 0, None).otherwise(F.col("id")).alias("doc_id"),
        F.when(F.col("id") % 3 == 0, "same").otherwise(F.concat(F.lit("text "), F.col("id"))).alias("text"), F.lit("a").alias("source"))
    keyed = rows.select("doc_id", F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), F.lit("s:a").alias("s"), F.lit(5).alias("size"),
                        F.crc32("text").alias("crc"), F.monotonically_increasing_id().alias("row"))
    plain = keyed.withColumn("b", F.shiftrightunsigned(F.xxhash64(F.lit(42), "id", "crc", "size"), 58))
    assert plain.groupBy("b").count().agg(F.max("count")).first()[0] >= 2000
    assert sharding.bucketed(keyed, 6000, 64, 42).groupBy("s", "b").count().agg(F.max("count")).first()[0] <= sharding.HOT * 6000 // 64
    got = sharding.assign(rows, 16).collect()
    per = Counter(r["shard"] for r in got)
    assert sorted(per.values()) == [375] * 16
    same = Counter(r["shard"] for r in got if r["doc_id"] is None)
    assert len(got) == 6000 and sum(same.values()) == 2000 and max(same.values()) - min(same.values()) < 80
    for s in range(16):
        assert sorted(r["slot"] for r in got if r["shard"] == s) == list(range(375))


def test_write_shards(spark, tmp_dir):
    docs = frame(spark)
    sharding.write_shards(sharding.assign(docs, 4), f"{tmp_dir}/shards", rows_per_file=5)
    assert spark.read.parquet(f"{tmp_dir}/shards").count() == docs.count()


def test_iban_letters_and_check_digits(spark):
    """Letters stay letters, digits digits; a valid number gives a valid one and another one does not."""
    given = ["GB82 WEST 1234 5698 7654 32", "NL91ABNA0417164300", "DE89 3704 0044 0532 0130 00", "MT84MALT011000012345MTLCAST001S",
             "GB83 WEST 1234 5698 7654 32", "DE00 3704 0044 0532 0130 00"]

    def valid(s):
        s = s.replace(" ", "")
        return int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97 == 1 and 2 <= int(s[2:4]) <= 98

    def shape(s):
        return re.sub("[A-Z]", "A", re.sub("[0-9]", "0", s))

    docs = spark.createDataFrame(list(enumerate(given)), "doc_id long, text string")
    got = {r["doc_id"]: r["text"] for r in surrogates.replace(docs, "k").collect()}
    for i, s in enumerate(given):
        assert got[i] != s and got[i][:2] == s[:2] and shape(got[i]) == shape(s)
        assert valid(got[i]) == valid(s)
