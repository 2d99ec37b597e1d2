import base64
import hashlib

import pytest

from corpusloom.llm import secrets as sc, warc
from corpusloom.session import scratch_path
from llm_data import DOCUMENT, text_of

PAGE = "page_id long, url string, html string"


def test_sort_keys():
    assert warc.sort_key("https://www.Blog.Example.com:80/a/b?x=1#top") == "com,example,blog)/a/b?x=1"
    assert warc.sort_key("http://example.com") == "com,example)/"
    assert warc.sort_key(None) == "" and warc.sort_key("no url") == "no url"


def page_rows():
    rows = [(k, f"http://h{k % 3}.example.com/{k % 7}", f"<p>page é {k % 11}</p>\r\n\r\nWARC/1.1\r\n\r\n{'x' * (k % 11)}") for k in range(60)]
    return rows + [(100, None, None), (101, "http://a.b/\r\nX: y", ""), (102, "http://a.b/", None), (103, "u\tv", "日本")]


def brute(rows, least=0):
    best = {}
    for key, _, html in rows:
        raw = (html or "").encode()
        best[raw] = max(best.get(raw, key), key)
    out = []
    for key, _, html in rows:
        raw = (html or "").encode()
        alone = best[raw] == key or len(raw) < least
        sha = base64.b32encode(hashlib.sha1(raw).digest()).decode()
        out.append((key, len(raw), sha, "response" if alone else "revisit", None if alone else best[raw]))
    return sorted(out)


@pytest.mark.parametrize("least", [0, 5, 100])
def test_round_trip(spark, least):
    rows = page_rows()
    frame = spark.createDataFrame(rows, PAGE).selectExpr("*", "1 as payload_digest", "2 as file")
    assert sorted(tuple(r) for r in warc.archive_and_read(frame, least).collect()) == brute(rows, least)


def test_payloads_files_and_index(spark, pages, monkeypatch):
    path = scratch_path(spark, "warc-test")
    warc.write_archives(pages, f"{path}/a", archive_bytes=50_000)
    assert warc.archive_files(spark, f"{path}/a").count() > 3
    entries = warc.capture_entries(spark, f"{path}/a").cache()
    assert entries.count() == pages.count()
    warc.write_index(entries, f"{path}/i", block_entries=7)
    index = spark.read.parquet(f"{path}/i")
    assert index.agg({"entries": "max"}).first()[0] <= 7 and index.count() >= pages.count() // 7
    asked = entries.select("key", "id").limit(20).unionByName(spark.createDataFrame([("zz", "none"), ("", "none")], "key string, id string"))
    for rows in (warc.DIRECTORY_ROWS, 3):
        monkeypatch.setattr(warc, "DIRECTORY_ROWS", rows)
        found = warc.find_captures(index, asked)
        assert sorted(found.collect()) == sorted(entries.join(asked, ["key", "id"]).select(*found.columns).collect())
    got = {r.page_id: r for r in warc.read_captures(spark, f"{path}/a", entries).collect()}
    want = {r.page_id: r for r in pages.collect()}
    assert all(got[k].payload == (want[k].html or "") for k in want if got[k].record_type == "response")
    assert all(got[k].url == want[k].url for k in want)


@pytest.mark.parametrize("blocks", [warc.DIRECTORY_ROWS, 6])
def test_repeated_rows_are_found_as_often(spark, monkeypatch, blocks):
    """The same rows for a directory in one part and in many."""
    path = scratch_path(spark, "warc-copies")
    names = [(f"k{k:02}", f"i{k}", "f", k, 1) for k in range(40)]
    entries = spark.createDataFrame(names, "key string, id string, file string, offset long, length long")
    warc.write_index(entries, f"{path}/i", block_entries=4)
    asked = [(f"k{k:02}", f"i{k}") for k in range(0, 40, 3) for _ in range(k % 4)] + [("k05", "none")] * 2
    monkeypatch.setattr(warc, "DIRECTORY_ROWS", blocks)
    found = warc.find_captures(spark.read.parquet(f"{path}/i"), spark.createDataFrame(asked, "key string, id string"))
    assert sorted((r.key, r.id) for r in found.collect()) == sorted(asked[:-2])


@pytest.mark.parametrize("blocks", [warc.DIRECTORY_ROWS, 3])
def test_every_record_of_an_id_is_its_own(spark, monkeypatch, blocks):
    """Rows of one id and URL with other html: each comes back with its own digest and size."""
    monkeypatch.setattr(warc, "DIRECTORY_ROWS", blocks)
    rows = [(1, "http://x.y/", f"<p>{'a' * k}</p>") for k in range(9)] + [(1, "http://x.y/", "<p></p>"), (2, "http://x.y/", "<p>b</p>")]
    frame = spark.createDataFrame(rows, PAGE)
    assert sorted(tuple(r) for r in warc.archive_and_read(frame).collect()) == sorted(brute(rows, 0))
    # The same over many small blocks, most of which begin with the same capture.
    path = scratch_path(spark, "warc-same")
    names = [("k", "same", "f", k, 1) for k in range(23)] + [("a", "x", "f", 90, 1), ("k", "zz", "f", 91, 1)]
    entries = spark.createDataFrame(names, "key string, id string, file string, offset long, length long")
    warc.write_index(entries, f"{path}/i", block_entries=4)
    asked = spark.createDataFrame([("k", "same"), ("k", "same"), ("k", "zz"), ("k", "no"), ("a", "x")], "key string, id string")
    found = warc.find_captures(spark.read.parquet(f"{path}/i"), asked, every=True)
    assert sorted(r.offset for r in found.collect()) == [*range(23), 90, 91]


def test_warc_edges(spark):
    assert warc.archive_and_read(spark.createDataFrame([], PAGE)).count() == 0
    rows = [(None, "http://x.y/", "a"), (1, "http://x.y/", "a"), (1, "http://x.y/", "a")]
    got = [tuple(r)[:2] + tuple(r)[3:] for r in warc.archive_and_read(spark.createDataFrame(rows, PAGE)).collect()]
    assert sorted(got, key=repr) == sorted([(None, 1, "response", None), (1, 1, "response", None), (1, 1, "response", None)], key=repr)


def test_damaged_record_is_an_error():
    raw = b"WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 2\r\n\r\nab\r\n\r\n"
    head, a, b = warc.read_record(raw, 0)
    assert raw[a:b] == b"ab" and head["warc-type"] == "response"
    with pytest.raises(ValueError):
        warc.read_record(raw, 3)


HEX = "6df57b16f87eabefefcab67b433e0123456789ab"


def secret_rows():
    rows = []
    for k in range(60):
        value = hashlib.sha1(str(k).encode()).hexdigest()
        name = ("token", "api_key", "my-secret", "PASSWORD")[k % 4]
        rows.append((k, f'{text_of(k, 30)} {name} = "{value}" {text_of(k + 500, 20)}', "en", "src/a", 1))
        rows.append((100 + k, f"{text_of(k, 30)} commit {value} {text_of(k + 700, 20)}", "en", "src/b", 1))
        rows.append((200 + k, f"{text_of(k, 30)} {10**15 + k * 7919} été {text_of(k, 20)}", "en", None, 1))
    return rows


def test_findings_and_verdicts(spark):
    rows = secret_rows()
    frame = spark.createDataFrame(rows, DOCUMENT)
    texts = {r[0]: r[1] for r in rows}
    got = sc.scan_secrets(frame).collect()
    assert all(texts[r.doc_id][r.start : r.start + r.length] == r.value for r in got)
    assert {r.doc_id for r in got} == set(texts)
    assert {r.doc_id for r in got if r.is_secret} == set(range(60))
    assert all(r.value_sha256 == hashlib.sha256(r.value.encode()).hexdigest() for r in got)


def test_values_assigned_without_spaces(spark):
    key = "ghp_" + "a1B2" * 9
    want = {
        "API_KEY=abcdEFGHijklMNOP": ["abcdEFGHijklMNOP"], "API_KEY=abcd1234EFGH5678": ["abcd1234EFGH5678"],
        "run --password=hunter2 now": ["hunter2"], "http://a.b/c?token=q7Zk21&client_secret=ab/cd+Ef==&n=1": ["q7Zk21", "ab/cd+Ef=="],
        'secret   :   "someLettersOnly"': ["someLettersOnly"], "a==b c=d width=1200 the word: nothing": [],
        "pwd=": [], "=": [], "token==abcdEFGH": [], "é PASSWD=xyZq": ["xyZq"],
    }
    frame = spark.createDataFrame([(k, t) for k, t in enumerate(want)], "doc_id long, text string")
    got = {t: [] for t in want}
    texts = list(want)
    for r in sorted(sc.find_candidates(frame).collect(), key=lambda r: r.start):
        assert r.assigned and texts[r.doc_id][r.start : r.start + r.length] == r.value
        got[texts[r.doc_id]].append(r.value)
    assert got == want
    issued = spark.createDataFrame([(1, f"x/{key} my-eyJhbGciOiJIUzI1 keyJhbGciOiJIUzI1")], "doc_id long, text string")
    assert sorted(r.value[:4] for r in sc.label_findings(sc.find_candidates(issued)).collect() if r.label == 1) == ["my-e", "x/gh"]
    rows = [*secret_rows(), (900, "export DB_PASSWORD=s3cretV4lue99x", "en", "src/a", 1), (901, "set API_KEY=abcdEFGHijklMNOP", "en", "src/a", 1)]
    found = {r.value: r for r in sc.scan_secrets(spark.createDataFrame(rows, DOCUMENT)).collect()}
    assert found["s3cretV4lue99x"].is_secret and found["abcdEFGHijklMNOP"].is_secret


def test_values_are_whole(spark):
    want = {
        "password: hunter2andmore!X$": ["hunter2andmore!X$"], "password: hunter2andmore!X$. Then": ["hunter2andmore!X$"],
        "\"db_password\" => 's3cr3t.value/with:colon', next": ["s3cr3t.value/with:colon"], "https://user:p4ssw0rdXY@host/a": ["p4ssw0rdXY"],
        'secret="two words, é and \\"more\\" 1"; x': ['two words, é and \\"more\\" 1'], 'token: "never4closed x': ["never4closed"],
        'key := `a\nb4567`': [], "Authorization: Bearer abc.d3f-g/h": ["abc.d3f-g/h"], "the access: (see there)": [], "http://host:8080/a@b": [],
        "pwd=ab&cd#12": ["ab&cd#12"], "/q?pwd=abcd&cd#12": ["abcd"], "password: " + "x1é$" * 3000: ["x1é$" * 3000], "====:::=": [],
    }
    frame = spark.createDataFrame([(k, t) for k, t in enumerate(want)], "doc_id long, text string")
    texts, found = list(want), sc.find_candidates(frame)
    got = {t: [] for t in want}
    for r in sorted(found.collect(), key=lambda r: r.start):
        assert r.assigned and texts[r.doc_id][r.start : r.start + r.length] == r.value
        got[texts[r.doc_id]].append(r.value)
    assert got == want
    # No part of a value stays.
    out = sc.redact(frame, found.selectExpr("*", "true as is_secret")).collect()
    for r in out:
        for value in want[texts[r.doc_id]]:
            assert r.text == texts[r.doc_id].replace(value, "[SECRET]")


def test_neighbours_are_whole_words(spark):
    value = "q7Zk21aaBB93"
    far = "w" * 200
    text = f"{far} one {value} two {far} three"
    row = sc.find_candidates(spark.createDataFrame([(1, text), (2, value)], "doc_id long, text string")).orderBy("doc_id").collect()
    assert row[0].before == ["one"] and row[0].after == ["two"] and row[1].before == row[1].after == []


def test_forest_learns_from_given_labels(spark):
    rows = secret_rows()
    frame = spark.createDataFrame(rows, DOCUMENT)
    # Labels that call the commits secrets: verdicts follow the labels, not the rule.
    found = sc.find_candidates(frame)
    even = found.filter("doc_id % 2 = 0").selectExpr("*", "cast(doc_id between 100 and 159 as int) as label")
    got = sc.scan_secrets(frame, even).collect()
    odd = [r for r in got if r.doc_id % 2]
    right = sum(r.is_secret == (100 <= r.doc_id < 160) for r in odd)
    assert right >= 0.95 * len(odd)


def test_redaction(spark):
    frame = spark.createDataFrame(
        [(1, f'é token = "{HEX}" and token: {HEX} end', "en", "s", 1), (2, None, None, None, None), (3, "", "en", "s", 0)], DOCUMENT
    )
    findings = sc.find_candidates(frame).selectExpr("*", "true as is_secret")
    out = {r.doc_id: r for r in sc.redact(frame, findings).collect()}
    assert out[1].text == 'é token = "[SECRET]" and token: [SECRET] end'
    assert out[2].text is None and out[3].text == ""
    assert sc.redact(frame, findings.limit(0)).collect() == frame.collect()


def test_features():
    logp, words = sc.np.zeros((sc.CLASSES, sc.CLASSES)), {b"the", b"tion"}
    plain = sc.features(b"thetionthe", "a/test/b.py", False, ["id"], [], logp, words)
    coded = sc.features(HEX.encode(), None, True, ["token"], ["end"], logp, words)
    assert len(plain) == len(coded) and plain[0] == 10 and plain[8] == 1.0 and coded[8] == 0.0
    assert plain[11] == 1.0 and plain[12] == 1.0 and coded[9] == coded[10] == 1.0


def test_secret_edges(spark, edge, nothing):
    assert sc.scan_secrets(nothing).count() == 0
    found = sc.scan_secrets(edge)
    # The long run of one letter has no digit and is assigned to nothing.
    assert found.count() == 0
    assert sc.redact(edge, found).columns == edge.columns and sc.redact(edge, found).count() == edge.count()
    no_path = edge.select("doc_id", "text")
    assert sc.scan_secrets(no_path).count() == 0


def test_training_is_bounded(spark, monkeypatch):
    frame = spark.createDataFrame(secret_rows(), DOCUMENT)
    logp, words = sc.corpus_statistics(frame)
    labelled = sc.label_findings(sc.with_features(sc.find_candidates(frame), logp, words))
    assert labelled.filter("label = 1").count() == 60
    model = sc.train(labelled, limit=40)
    assert model.getNumTrees == sc.TREES and model.numFeatures == len(labelled.first().features)
    assert sc.train(labelled.filter("label = 0")) is None
