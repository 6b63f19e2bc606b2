"""Hand-written edge cases, compared with plain-Python models of the same rules."""

import html
import json
import random
import re

import pytest
from pyspark.sql import functions as F

from quillmine.functions import ids, lexicon, markup, replies, scoring, text
from quillmine.operators import chat, evidence, graph, match, reports, resolve, sampling, state
from quillmine.sources import responses, tables
from quillmine.streaming import ingest


def values(spark, inputs, expression, kind="string"):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(inputs)], f"i int, x {kind}")
    return [r[0] for r in df.orderBy("i").select(expression(F.col("x"))).collect()]


TEXTS = [None, "", "  ", "A b. C d! e? F", 'Said so. "Yes." (No.) Then.', "e.g. This", "a b. C\x1cd", "No end", "x.y. Z", "<i>Über</i> α-Test, 2nd", "日本語", "!?.", "WT Growth"]


def test_titles_and_dois(spark):
    def model(t):
        return re.sub(r"\s+", " ", re.sub(r"[^a-z0-9]+", " ", re.sub(r"<[^>]+>", " ", (t or "").lower()))).strip()

    assert values(spark, TEXTS, ids.normalize_title) == [model(t) for t in TEXTS]
    dois = ["https://doi.org/10.1/X", "doi:10.1/x", " 10.1/X ", "http://dx.doi.org/10.1/x", "", None, "HTTPS://DOI.ORG/doi:10.1/x"]
    assert values(spark, dois, ids.normalize_doi) == ["10.1/x", "10.1/x", "10.1/x", "http://dx.doi.org/10.1/x", "", "", "10.1/x"]


def test_sentences(spark):
    def model(t):
        flat = " ".join((t or "").split())
        return [s for s in re.split(r"""(?<=[.!?])\s+(?=[A-Z("'])""", flat) if s.strip()]

    assert values(spark, TEXTS, text.sentences) == [model(t) for t in TEXTS]


def test_lexicon(spark):
    words = {"a": ["WT", "growth*", "x.y"], "b": ["ΔrecA"], "c": []}
    got = values(spark, ["growths of wt", "δreca", None, "x.y"], lambda c: lexicon.tag(c, words))
    assert got == [{"a": ["WT", "growth*"]}, {"b": ["ΔrecA"]}, {}, {"a": ["x.y"]}]
    assert values(spark, ["awt", "a wt", "growths", "regrowth", "xzy"], lambda c: F.size(lexicon.hits(c, words["a"], words=True))) == [0, 1, 1, 0, 0]
    assert lexicon.any_of(["one two", "three"], "Homo sapiens") == '"Homo sapiens" AND ("one two" OR three)'


def test_accessions(spark):
    got = values(spark, ["DSM 14401, ATCC-123.5 dsm 99 DSM 14401", None], lambda c: ids.collection_strains(c, ["DSM", "ATCC"]))
    assert got == [["ATCC-123.5", "DSM 14401"], []]
    kinds = {"biosample": r"\bSAM[NED]A?\d{6,}\b", "wgs": r"\b[A-Z]{4,6}\d{8,}\b"}
    assert values(spark, ["SAMN12345678"], lambda c: ids.accessions(c, kinds)) == [{"biosample": ["SAMN12345678"], "wgs": ["SAMN12345678"]}]


def test_strains_and_names(spark):
    assert values(spark, ["Escherichia coli K-12, and Bacillus subtilis", "Vibrio", "a b / c", None, "x y and z w"], ids.binomial) == ["Escherichia coli", "Vibrio", "a b", "", "x y"]
    assert values(spark, ["K-12 (lab)", "(x)", None], ids.strain_token) == ["K-12", "", ""]
    assert values(spark, ["K-12", "", "N/A", "Unspecified strain", None], lambda c: ids.strain_resolvable(c, match.UNRESOLVED)) == [True, False, False, False, False]


REPLIES = [
    '[{"a": 1}, {"b": "x]}"}]', '```json\n{"a": 1}\n```', 'Here: [{"a": "q\\"}"}, {"b": 2}', "<think>{</think>[1, {\"a\": null}]", "nothing", None, '{"a": {"b": [1]}} trailing', '[{"a": 1}, {bad}, {"c": 3}]', "[]", '[{"a": "cut', 'text [1] {"x": 2}',
]


def model_objects(reply):
    reply = re.sub(r"<think>.*?</think>", "", reply or "", flags=re.S).strip()
    reply = re.sub(r"^```(?:json)?\s*|\s*```$", "", reply, flags=re.M)
    start, out, depth, begun, quoted, escaped = reply.find("["), [], 0, None, False, False
    for i in range(start + 1, len(reply)) if start >= 0 else ():
        c = reply[i]
        if quoted:
            escaped, quoted = (c == "\\" and not escaped), not (c == '"' and not escaped)
            continue
        if c == '"':
            quoted, escaped = True, False
        elif c == "{":
            begun = i if not depth else begun
            depth += 1
        elif c == "}":
            depth -= 1
            if not depth and begun is not None:
                try:
                    out.append(json.loads(reply[begun : i + 1]))
                except ValueError:
                    pass
        elif c == "]" and not depth:
            break
    return out


def test_replies(spark):
    assert [replies.complete_objects(r) for r in REPLIES] == [model_objects(r) for r in REPLIES]
    got = values(spark, REPLIES, replies.extract_json)
    assert [None if g is None else json.loads(g) for g in got] == [[{"a": 1}, {"b": "x]}"}], {"a": 1}, {"a": 'q"}'}, [1, {"a": None}], None, None, {"a": {"b": [1]}}, {"a": 1}, [], None, {"x": 2}]


def test_markup(spark):
    pub = "<S><PubmedArticle><MedlineCitation><PMID>7</PMID><Article><ArticleTitle>A <i>b</i></ArticleTitle><Abstract><AbstractText Label='AIM'>x</AbstractText><AbstractText>y</AbstractText></Abstract><Journal><Title>J</Title><JournalIssue><PubDate><MedlineDate>1999 Jan</MedlineDate></PubDate></JournalIssue></Journal><AuthorList><Author><LastName>L</LastName><ForeName>F</ForeName></Author><Author/></AuthorList><PublicationTypeList><PublicationType>Review</PublicationType></PublicationTypeList></Article></MedlineCitation><PubmedData><ArticleIdList><ArticleId IdType='doi'>10.1/x</ArticleId></ArticleIdList></PubmedData></PubmedArticle></S>"
    (r,) = markup.pubmed_records(pub)
    assert r == {"pmid": "7", "doi": "10.1/x", "pmcid": "", "title": "A b", "abstract": "AIM: x y", "journal": "J", "year": "1999", "authors": "L F", "pub_types": ["Review"]}
    assert markup.pubmed_records("<broken") == [] and markup.cited_rows(None) == []
    doc = "<a xmlns:l='http://www.w3.org/1999/xlink'><table-wrap><label>T</label><tr><td>x</td></tr><tr><th>h <xref ref-type='bibr' rid='r1'/></th><td><italic>Gen</italic> <xref ref-type='bibr' rid='r2'/><xref ref-type='bibr' rid='none'/></td></tr></table-wrap><ref id='r1'>see 10.1234/abc.5). </ref><ref id='r2'><ext-link ext-link-type='doi' l:href='10.2/y'/><ext-link ext-link-type='google-scholar' l:href='http://s?x=1&amp;title=The+t'/></ref></a>"
    got = [(x["row_index"], x["row_text"], x["organism_guess"], x["cited_doi"], x["cited_title"]) for x in markup.cited_rows(doc)]
    assert got == [(1, "Gen | h", "Gen", "10.1234/abc.5", ""), (1, "Gen | h", "Gen", "10.2/y", "The t")]


def test_articles(spark):
    doc = "<x><front><p>no</p></front><body><p>First. Second one.</p><sec><title>M</title><p>In <b>M</b>.</p><sec><p>Deep.</p></sec><fig><p>no</p></fig></sec></body></x>"
    assert text.body_paragraphs(doc) == [("", 0, "First. Second one."), ("M", 1, "In M."), ("M", 2, "Deep.")]
    df = spark.createDataFrame([(doc, None, None), (None, "a b.\n\n\nC d. E", "x"), ("<bad", "", "<h4>Aim</h4>We &amp; do."), (None, None, None)], "a string, p string, t string")
    found, name = text.best_sentences(F.col("a"), F.col("p"), F.col("t"))
    got = df.select(name.alias("n"), F.transform(found, lambda s: s["text"]).alias("s")).collect()
    assert [tuple(r) for r in got] == [("jats", ["First.", "Second one.", "In M.", "Deep."]), ("pdf", ["a b.", "C d.", "E"]), ("abstract", [".", "Aim: We & do."]), ("none", None)]
    assert values(spark, ["&lt;i&gt;A&lt;/i&gt; b &amp; c", None], text.clean_title) == ["A b & c", ""]
    assert html.unescape("&amp;") == "&"


def test_title_query_on_odd_titles(spark, tmp_path):
    """The query's titles are those of its SQL: entities cut off before their semicolon, others than its five, nested ones, no page at all."""
    import duckdb

    from quillmine.plans.registry import ORACLES, QUERIES

    titles = ["a &amp", "a &quot b&amp", "&am", "&gt;&#39;&nbsp;x", "&amp;lt;i&amp;gt;", "&lt;i>x</i>&copy;&middot;", "&amp;amp;", "a<b\nc>d<>", "&lt;&amp;>y", ""]
    pages = [f"<html><title>{t}</title><title>2</title>" for t in titles] + ["no title", "", None, "<title>open"]
    spark.createDataFrame(list(enumerate(pages)), "page_id long, html string").write.parquet(f"{tmp_path}/pages.parquet")
    con = duckdb.connect()
    con.execute(f"create view pages as select * from '{tmp_path}/pages.parquet/*.parquet'")
    assert sorted(map(tuple, QUERIES["html_title_clean"](spark, str(tmp_path)).collect())) == sorted(con.execute(ORACLES["html_title_clean"]).fetchall())


def greedy_model(records):
    entities, index = [], {}
    norm = lambda t: re.sub(r"[^a-z0-9]+", " ", t.lower()).strip()
    for r in records:
        keys = [f"{k}:{v}" for k, v in (("doi", r[1]), ("pmid", r[2]), ("title", norm(r[3]))) if v]
        e = next((index[k] for k in keys if k in index), None)
        if e is None:
            e = {"doi": r[1], "pmid": r[2], "title": r[3], "n": 0}
            entities.append(e)
        e["doi"], e["pmid"], e["n"] = e["doi"] or r[1], e["pmid"] or r[2], e["n"] + 1
        for k, v in (("doi", e["doi"]), ("pmid", e["pmid"]), ("title", norm(e["title"]))):
            if v:
                index[f"{k}:{v}"] = e
    return sorted((e["doi"], e["pmid"], e["title"], e["n"]) for e in entities)


def test_greedy_merge_is_the_sequential_one(spark):
    rng = random.Random(5)
    pick = lambda p, n: rng.choice([""] + [f"{p}{i}" for i in range(n)])
    for _ in range(3):
        rows = [(i, pick("d", 12), pick("p", 12), pick("Title ", 15)) for i in range(60)]
        df = spark.createDataFrame(rows, "n long, doi string, pmid string, title string").repartition(3)
        got = resolve.resolve_greedy(df.withColumn("discovery_route", F.lit("r"))).collect()
        assert sorted((r.doi, r.pmid, r.title, r.n_records) for r in got) == greedy_model(rows)
    abc = spark.createDataFrame([(0, "d1", "", "t1"), (1, "d2", "", "t2"), (2, "d1", "", "t2")], "n long, doi string, pmid string, title string")
    assert resolve.resolve_components(abc).count() == 1 and resolve.resolve_greedy(abc).count() == 2


def test_merge_policy(spark):
    rows = [(0, "d", "", "T", "b", "q", "s1", "n", False, True), (1, "d", "7", "U", "a", "q", "s1", "n", True, False), (2, "d", "8", "U", "c", "q2", "s2", "m", None, None)]
    df = spark.createDataFrame(rows, "n long, doi string, pmid string, title string, discovery_route string, discovery_query string, review_seed_doi string, notes string, is_review boolean, full_text_available boolean")
    (r,) = resolve.resolve_greedy(df).collect()
    assert (r.title, r.pmid, r.discovery_route, r.discovery_query, r.review_seed_doi, r.notes, r.is_review, r.full_text_available) == ("T", "7", ["a", "b", "c"], "q || q2", "s1; s2", "n || n || m", True, True)


def test_upsert(spark):
    kind = "k string, title string, sources array<string>, status string"
    old = spark.createDataFrame([("a", "x", ["s2"], "extraction_complete"), ("b", "", ["s1"], "discovered")], kind)
    new = spark.createDataFrame([("a", "", ["s1"], "discovered"), ("b", "y", ["s1"], "metadata_fetched"), ("c", "z", None, "discovered")], kind)
    got = {r.k: tuple(r)[1:] for r in state.upsert(old, new, "k", sets=["sources"], monotone="status").collect()}
    assert got == {"a": ("x", ["s1", "s2"], "extraction_complete"), "b": ("y", ["s1"], "metadata_fetched"), "c": ("z", [], "discovered")}
    assert {r.k: r.status for r in state.upsert(old, new, "k", sets=["sources"]).collect()}["a"] == "discovered"


def test_evidence(spark):
    sources = spark.createDataFrame([(1, ["A  small step.", ""]), (2, [])], "k int, sentences array<string>")
    quotes = spark.createDataFrame([(1, "small STEP"), (1, "It is a small step. Yes"), (1, "large"), (1, ""), (2, "x"), (3, "x"), (1, None)], "k int, q string")
    assert [r.verified for r in evidence.verify(quotes.coalesce(1), sources, "k", ["q"], empty=False).orderBy("k", F.length("q")).collect()] == [False, False, False, True, True, False, False]
    assert evidence.verify(quotes, sources, "k", ["q"], empty=True).where("verified").count() == 4


def quota_model(pools, limit):
    n, t, o = (pools.get(p, []) for p in ("negative", "table", "other"))
    a, b = (max(1, round(limit * q)) if x else 0 for q, x in ((0.35, n), (0.45, t)))
    chosen = n[:a] + t[:b]
    return (chosen + (n[a:] + t[b:] + o)[: max(0, limit - len(chosen))])[:limit]


@pytest.mark.parametrize("limit", [1, 2, 10, 30])
def test_quota(spark, limit):
    for sizes in ((0, 0, 5), (2, 20, 20), (20, 1, 0), (20, 20, 20)):
        pools = {p: [f"{p}{i:02}" for i in range(n)] for p, n in zip(("negative", "table", "other"), sizes)}
        df = spark.createDataFrame([(p, x) for p, xs in pools.items() for x in xs], "pool string, n string")
        got = sampling.quota_batch(df, limit).orderBy("place").collect()
        assert [r.n for r in got] == quota_model(pools, limit)


def test_greedy_quota(spark):
    rng = random.Random(1)
    hits = [(t, f"t{t}", p, r, rng.randrange(30)) for t in range(4) for p in range(2) for r in range(25)]
    taken, used, want = set(), {}, []
    for t, name, p, r, x in hits:
        if x not in taken and used.get(t, 0) < 6:
            taken.add(x)
            used[t] = used.get(t, 0) + 1
            want.append((name, p, r, x))
    df = spark.createDataFrame(hits, "topic_no int, topic string, pass int, rank int, paper_id int").repartition(3)
    assert sorted(tuple(r) for r in sampling.greedy_quota(df, 6).collect()) == sorted(want)


def test_match(spark):
    catalog = spark.createDataFrame([("GCF_1", "Esch coli", "Esch coli K-12", 1), ("GCF_2", "Esch coli X", "esch coli b", 2), ("GCF_3", "Esch coli", "Esch coli K-12 sub", 3)], "accession string, organism string, match_text string, rank int")
    rows = [(1, "Esch coli", "coli b"), (2, "Esch coli", "k-12 (lab)"), (3, "Esch coli", "unknown"), (4, "Esch coli", "zzz"), (5, "Esch", "b"), (6, "No such", "b"), (7, None, None)]
    got = {r.observation_id: (r.genome_match_status, r.accession) for r in match.catalog_match(spark.createDataFrame(rows, "observation_id int, organism_name string, strain_name string"), catalog).collect()}
    assert got == {1: ("exact_strain_match", "GCF_2"), 2: ("multiple_possible_matches", "GCF_1"), 3: ("species_only_match", "GCF_1"), 4: ("species_only_match", "GCF_1"), 5: ("not_checked", ""), 6: ("no_genome_found", ""), 7: ("not_checked", "")}


def test_graph(spark):
    edges = spark.createDataFrame([(1, 2, "r"), (2, 1, "r"), (2, 3, "c"), (3, 3, "r"), (4, 5, "r")], "src int, dst int, label string")
    seeds = spark.createDataFrame([(1,), (9,)], "node int")
    for depth, want in ((0, {1: 0, 9: 0}), (1, {1: 0, 9: 0, 2: 1}), (5, {1: 0, 9: 0, 2: 1, 3: 2})):
        assert {r.node: r.hop for r in graph.breadth_first(edges, seeds, depth).collect()} == want
    rng = random.Random(2)
    pairs = [(rng.randrange(80), rng.randrange(80)) for _ in range(60)] + [(100 + i, 101 + i) for i in range(40)]
    root = {x: x for p in pairs for x in p}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in pairs:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    got = {r.node: r.root for r in graph.components(spark.createDataFrame(pairs, "u long, v long")).collect()}
    assert all(got.get(x, x) == find(x) for x in root)


def test_chat(spark):
    calls = spark.createDataFrame([(i, "fail" if i % 2 else "fine") for i in range(10)] + [(11, None)], "i int, prompt string").coalesce(1)

    def client(system, prompt):
        if prompt == "fail":
            raise chat.ChatError("down")
        return system + prompt

    got = {r.i: (r.reply, r.error) for r in chat.ask(calls, client, "s:", pause_s=0.0).collect()}
    assert got[0] == ("s:fine", None) and got[1] == (None, "down") and got[11] == (None, None)
    with pytest.raises(Exception, match="failed in a row"):
        chat.ask(calls.where("prompt = 'fail'"), client, "s:", breaker=3, pause_s=0.0).collect()


def test_observations(spark):
    reply = json.dumps([{"organism_name": "O", "evidence_text": " Seen here. ", "outcome": "success", "manipulation_category": "odd", "wild_type_status": "yes", "organism_domain": "x"}, {"strain_name": "no organism"}, {"organism_name": "P", "outcome": None}])
    asked = spark.createDataFrame([("p", reply, ["We have seen here."], "jats"), ("q", '{"organism_name": "O"}', [], "jats"), ("r", None, [], "jats")], "paper_id string, reply string, sentences array<string>, text_source string")
    vocab = {"manipulation_category": ["transformation"], "outcome": ["success"], "wild_type_status": ["yes"], "organism_domain": ["bacteria"]}
    a, b = chat.observations(asked, vocab).orderBy("observation_id").collect()
    assert (a.observation_id, a.qc_flags, a.manipulation_category, a.manipulation_detail, a.organism_domain) == ("p-OBS01", "manipulation_category_uncertain", "other", "odd", "bacteria")
    assert (b.observation_id, b.qc_flags) == ("p-OBS03", "evidence_unverified manipulation_category_uncertain outcome_uncertain wild_type_uncertain")
    prompt = chat.spans_prompt(F.create_map(F.lit("a"), F.array(F.struct(F.lit("s1").alias("sentence")))), ["a", "b"])
    assert spark.range(1).select(prompt).first()[0] == "## a\n- s1"


def test_csv_and_packets(spark, tmp_path):
    fields = ["a", "b", "c", "d", "e"]
    df = spark.createDataFrame([("x, \"y\"\nz", True, ["t", "s", "t"], None, 1)], "a string, b boolean, c array<string>, d string, more int")
    tables.write_csv(df, f"{tmp_path}/t", fields)
    assert [tuple(r) for r in tables.read_csv(spark, f"{tmp_path}/t", fields).collect()] == [('x, "y"\nz', "True", "s|t", "", "")]
    assert tables.read_csv(spark, f"{tmp_path}/none", fields).count() == 0
    tables.write_packets(df.select("a", "c"), f"{tmp_path}/p")
    (tmp_path / "p" / "bad.json").write_text("{broken")
    got = tables.read_packets(spark, f"{tmp_path}/p", df.select("a", "c").schema).cache()
    assert got.where("_corrupt IS NULL").count() == 1 and got.where("_corrupt IS NOT NULL").count() == 1
    (tmp_path / "l.txt").write_text("# no\n\n one \ntwo\n")
    assert [r[0] for r in tables.read_list(spark, f"{tmp_path}/l.txt").collect()] == ["one", "two"]
    assert {r[0] for r in tables.file_keys(spark, f"{tmp_path}/p", ".json").collect()} >= {"bad"}


def test_responses(spark):
    class Stub(responses.ResponseSource):
        @staticmethod
        def transport(url):
            if "gone" in url:
                return 404, None
            return 200, json.dumps({"resultList": {"result": [{"title": "T.", "doi": "10.1/x", "isOpenAccess": "Y", "pubTypeList": {"pubType": ["Review"]}, "authorList": {"author": [{"fullName": "A B"}, {"fullName": "C"}]}}, {"title": None}]}})

    cache = responses.fetched(spark, Stub, ["https://h/1", "https://h/gone", "https://i/2"], pace=0.0).cache()
    assert cache.count() == 2
    queries = spark.createDataFrame([("q1", "https://h/1"), ("q2", "https://h/gone")], "query string, url string")
    assert [r.url for r in responses.missing(queries, cache).collect()] == ["https://h/gone"]
    (r,) = responses.discovered(queries, cache, "broad_keyword").collect()
    assert (r.title, r.authors, r.is_open_access, r.is_review, r.discovery_query, r.year) == ("T", "A B; C", True, True, "q1", "")
    bioc = json.dumps([{"documents": [{"passages": [{"infons": {"section_type": "METHODS"}, "text": "a"}, {"infons": {}, "text": " "}, {"infons": {"section_type": "suppl"}, "text": "b"}]}]}])
    got = responses.passages(spark.createDataFrame([("p", bioc), ("q", None)], "paper_id string, body string")).orderBy("pos").collect()
    assert [(x.bucket, x.paragraph, x.text) for x in got] == [("METHODS", 1, "a"), ("SUPPLEMENT", 2, "b")]
    pages = responses.pages_of(spark.range(1000).withColumn("o", F.col("id")), "id", "o", 200).collect()
    assert sum(len(p.ids) for p in pages) == 1000 and max(len(p.ids) for p in pages) <= 200


def test_streams(spark, tmp_path):
    rows = spark.createDataFrame([(i, f"r{i % 3}", f"2024-01-01 00:{i:02}:00") for i in range(20)], "id long, route string, t string").withColumn("ts", F.to_timestamp("t"))
    rows.repartition(4).write.parquet(f"{tmp_path}/in")
    schema = rows.select("id", "route").schema
    stream = lambda: spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    merge = lambda old, new: old.unionByName(new.select("id", "route")).dropDuplicates(["id"])
    ingest.ingest(stream(), f"{tmp_path}/state", f"{tmp_path}/cp", schema, merge)
    ingest.ingest(stream(), f"{tmp_path}/state", f"{tmp_path}/cp", schema, merge)
    assert ingest.read_state(spark, f"{tmp_path}/state", schema).count() == 20
    out = ingest.windowed_routes(stream(), "ts", "route", "10 minutes", "1 minute").writeStream.outputMode("complete").format("memory").queryName("routes").trigger(availableNow=True).start()
    out.awaitTermination()
    assert spark.sql("select sum(n) from routes").first()[0] == 20


def test_scores(spark):
    p = scoring.Phrases(technique=["tech"], failure=["fail"], success=["succ"])
    df = spark.createDataFrame([("METHODS", "tech fail succ"), ("SUPPLEMENT", "tech"), ("OTHER", "tech fail"), ("RESULTS", None)], "b string, t string")
    assert [r[0] for r in df.select(scoring.passage_points(F.col("b"), F.col("t"), p)).collect()] == [15, 3, 0, 0]
    assert values(spark, ["three  strains", "ten strain", "strains", "12 STRAINS of"], lambda c: c.rlike(scoring.MULTI_STRAIN)) == [True, True, False, True]
    assert values(spark, ["METHODS", "intro", None, "suppl"], lambda c: scoring.bucket_of(c, responses.SECTION_BUCKETS)) == ["METHODS", "OTHER", "OTHER", "SUPPLEMENT"]
    assert reports.backlog(spark.createDataFrame([(5, 7, 2)], "n_a long, n_b long, n_c long"), ["a", "b", "c"]).first().largest_backlog == 5


def test_vocabulary(spark):
    from quillmine.functions import vocabulary as v

    assert [len(v.SENTENCE_LEXICON[c]) for c in v.SENTENCE_LEXICON] == [45, 8, 11, 28, 32, 14, 22, 39]
    got = values(spark, ["No transformants of strain ΔrecA (DSM 14401, SAMN12345678) were found.", "growth"], lambda c: F.map_keys(lexicon.tag(c, v.SENTENCE_LEXICON)))
    assert got == [["manipulation", "strain", "failure", "not_wild_type"], ["strain", "wild_type"]]
    assert values(spark, ["DSM 14401, SAMN12345678"], lambda c: F.map_keys(ids.accessions(c, v.ACCESSIONS))) == [["wgs_master", "biosample"]]
    assert values(spark, ["Genetic tools for marine bacteria", "Marine bacteria", None], v.relevant_review) == [True, False, False]
    df = spark.createDataFrame([("A genetic system", "By electroporation and conjugation no colonies; transformants obtained")], "t string, a string")
    assert df.select(scoring.abstract_score(F.col("t"), F.col("a"), v.PHRASES)).first()[0] == 6 + 6 + 4 + 3
    assert values(spark, ["CRISPRi and mating", "x"], lambda c: lexicon.first_category(c, v.TECHNIQUES)) == ["conjugation", "other"]
