"""Components, chains of merges, clashes, folders with limits, rejects, undone roles and misspelt names on small, odd rows."""

import json
import random

import pytest
from pyspark.sql import functions as F

from foliant.functions import places
from foliant.operators import cleanup, entities, resolve, venues
from foliant.operators.identity import connected, named_keys
from foliant.operators.venue_conflicts import settle
from foliant.plans import delete_works, ingest, load, load_venues
from foliant.scratch import Scratch

VENUE = "id long, name string, type string, issn string, eissn string, openalex_id string, scopus_id string, open_access int"


def test_connected_against_plain_search(spark):
    rng = random.Random(5)
    rows = [(k, rng.choice([None, f"x{rng.randint(0, 60)}"]), rng.choice([None, f"y{rng.randint(0, 60)}"])) for k in range(120)]
    rows += [(200 + k, f"chain{k}", f"chain{k + 1}") for k in range(40)] + [(300, None, None), (301, None, None), (5, "again", None), (None, "x1", None)]
    df = spark.createDataFrame(rows, "rid long, a string, b string")
    got = {r.rid: r.root for r in connected(df, "rid", F.array("a", "b")).collect()}
    root = {r: r for r, _, _ in rows if r is not None}
    for _ in rows:  # as many rounds as any chain is long
        for key in {x for _, *keys in rows for x in keys if x}:
            mine = [r for r, *keys in rows if key in keys and r is not None]
            for r in mine:
                root[r] = min(root[x] for x in mine)
    assert got == root
    assert connected(df.limit(0), "rid", F.array("a")).collect() == []
    kept = df.select(named_keys(a=F.col("a"), b=F.col("a")).alias("k")).where("a = 'x1'").limit(1).collect()
    assert all(r.k == ["a:x1", "b:x1"] for r in kept)


def test_rounds_of_a_long_chain_write_less_and_less(spark, monkeypatch):
    """All rounds together write little more than the chain's pairs; each used to write every record again."""
    n, written = 2000, []
    write = Scratch.write

    def counted(self, df, name):
        out = write(self, df, name)
        written.append(out.count())
        return out

    monkeypatch.setattr(Scratch, "write", counted)
    df = spark.range(n).select(F.col("id").alias("rid"), F.concat(F.lit("k"), "id").alias("a"), F.concat(F.lit("k"), F.col("id") + 1).alias("b"))
    got = connected(df, "rid", F.array("a", "b"))
    assert got.where("root = 0").count() == n
    assert sum(written) < 12 * n


def test_records_that_say_the_same_are_looked_up_once(spark, monkeypatch):
    """Two sorts of records, one stored; columns that are NULL are equal, too. Each record used to be written six times and more."""
    n, written = 600, []
    write = Scratch.write

    def counted(self, df, name):
        out = write(self, df, name)
        written.append(out.count())
        return out

    monkeypatch.setattr(Scratch, "write", counted)
    held = load.empty(spark)["organizations"].unionByName(spark.createDataFrame([(7, "Old", "INSTITUTE")], "id long, name string, type string"), allowMissingColumns=True)
    said = spark.range(n).selectExpr("id rid", "if(id % 3 = 0, 'old', 'New') name", "'INSTITUTE' type", "if(id % 3 = 1, 'r1', null) ror_id")
    out, links = entities.organizations(held, said)
    assert sorted((r.id, r.name, r.ror_id) for r in out.collect()) == [(7, "Old", None), (8, "New", "r1")]
    assert {r.rid: r.id for r in links.collect()} == {k: 7 if k % 3 == 0 else 8 for k in range(n)}
    assert sum(written) < 2.2 * n


def test_new_entities_share_no_unique_value(spark):
    """The three runs that used to make two entities of one."""
    orgs = load.empty(spark)["organizations"]
    said = spark.createDataFrame([(1, "A", "INSTITUTE", "r1", "I1"), (2, "B", "INSTITUTE", None, "I1")], "rid long, name string, type string, ror_id string, openalex_id string")
    out, links = entities.organizations(orgs, said)
    assert [(r.name, r.ror_id, r.openalex_id) for r in out.collect()] == [("A", "r1", "I1")] and links.select("id").distinct().count() == 1
    held = spark.createDataFrame([], "id long, name string, type string, issn string, eissn string, openalex_id string")
    two = spark.createDataFrame([(1, "J", "JOURNAL", "2222-2222", None, "S1"), (2, "K", "JOURNAL", None, "2222-2222", "S2")], "rid long, name string, type string, issn string, eissn string, openalex_id string")
    assert entities.venues(held, two)[0].count() == 1
    empty, none = entities.venues(held, two.limit(0))
    assert empty.count() == 0 and none.count() == 0
    nameless, links = entities.venues(held, two.withColumn("name", F.lit(None).cast("string")))
    assert nameless.count() == 0 and links.count() == 0
    c = {"venues": load_venues_schema(spark), "organizations": spark.createDataFrame([], "id long, name string, type string")}
    c |= {"subjects": load.empty(spark)["subjects"], "venue_subjects": spark.createDataFrame([], "venue_id long, subject_id long, score double, source string")}
    ranked = [("f", "1", "X", "journal", "22222222", "P", "Iran", "A (Q1)", "1,5", "3", "Yes"), ("f", "1", "Y", "journal", "33333333, 22222222", "P", "Iran", "B", "2", "4", "No"), ("f", "9", "Z", "journal", "33333333", "", "", None, "x", "", "")]
    names = "path string, Sourceid string, Title string, Type string, Issn string, Publisher string, Country string, Categories string, SJR string, `H index` string, `Open Access` string"
    out, ids = load_venues.scimago(c, spark.createDataFrame(ranked, names), F.lit("now"))
    assert out["venues"].count() == 1 and ids.select("id").distinct().count() == 1


def load_venues_schema(spark):
    return spark.createDataFrame([], "id long, name string, type string, issn string, eissn string, scopus_id string, publisher_id long, country_code string, sjr double, open_access int, h_index long, is_indexed_in_scopus int, validation_status string, last_validated_at string")


def test_chains_of_merges(spark):
    pairs = spark.createDataFrame([(5, 4), (4, 3), (3, 1), (9, 4), (9, 8), (7, 7)], "duplicate long, canonical long")
    assert {(r.duplicate, r.canonical) for r in resolve.followed(pairs).collect()} == {(5, 1), (4, 1), (3, 1), (9, 1)}
    with pytest.raises(ValueError):
        resolve.followed(spark.createDataFrame([(1, 2), (2, 3), (3, 1)], "duplicate long, canonical long"))
    ids = spark.createDataFrame([(k, f"V{k}", "JOURNAL") for k in range(1, 10)], "id long, name string, type string")
    c = venues.merge_in({"venues": ids, "publications": spark.createDataFrame([(1, 5), (2, 9), (3, None), (4, 99)], "id long, venue_id long")}, pairs.unionByName(spark.createDataFrame([(2, 77)], "duplicate long, canonical long")))
    assert {r.id for r in c["venues"].collect()} == {1, 2, 6, 7, 8}
    assert {(r.id, r.venue_id) for r in c["publications"].collect()} == {(1, 1), (2, 1), (3, None), (4, 99)}


def test_clashes_in_a_ring_and_between_issn_columns(spark):
    stored = spark.createDataFrame([(1, "A", "JOURNAL", "1111-1111", None, None, None, None), (2, "B", "JOURNAL", None, None, "S2", None, 1), (3, "C", "JOURNAL", None, "3333-3333", None, None, None)], VENUE)
    ring = spark.createDataFrame([(1, 1, None, "S2"), (2, 2, "1111-1111", None)], "rid long, id long, issn string, openalex_id string")
    policy = venues.POLICY["openalex"]
    done = settle(stored, ring, policy)
    assert [(r.duplicate, r.canonical) for r in done.merged.collect()] == [(2, 1)]
    assert [(r.id, r.issn, r.openalex_id, r.open_access) for r in done.venues.where("id = 1").collect()] == [(1, "1111-1111", "S2", 1)]
    across = spark.createDataFrame([(1, 2, "3333-3333")], "rid long, id long, issn string")
    assert settle(stored, across, policy).merged.count() == 0
    assert settle(stored, across, policy, merging=False, both_issns=True).lost.collect()[0].value == "3333-3333"
    assert [(r.duplicate, r.canonical) for r in settle(stored, across, policy, both_issns=True).merged.collect()] == [(3, 2)]
    none = settle(stored, across.limit(0), policy)
    assert none.venues.count() == 3 and none.records.count() == 0


def test_load_of_a_tree_with_broken_files(spark, tmp_path):
    def put(name, text):
        path = tmp_path / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(text if isinstance(text, str) else json.dumps(text))

    work = lambda doi, title="On Rivers": {"message": {"DOI": doi, "title": [title], "type": "journal-article"}}
    put("a/1.json", work("10.1/A"))
    put("a/2.json", "{not json")
    put("a/3.json", work("10.1/a", "A Second Copy"))
    put("b/1.json", {"status": "not-found"})
    put("b/2.json", work("10.1/b", "Untitled"))
    put("b/3.json", work("10.1/c"))
    put("b/4.json", "")
    done = ingest.load_tree(spark, f"file://{tmp_path}", "crossref", load.empty(spark))
    reasons = {r.path.rsplit("/", 2)[-2] + "/" + r.path.rsplit("/", 1)[-1]: r.reason for r in done.rejects.collect()}
    assert reasons == {"a/2.json": "unreadable", "a/3.json": "duplicate", "b/1.json": "crossref:status=not-found", "b/2.json": "crossref:title_exact=untitled"}
    assert done.counters["read"] == 6 and done.counters["inserted"] == 2 and done.counters["rejected"] == 4 and done.catalog["works"].count() == 2
    few = ingest.raw_files(spark, f"file://{tmp_path}", 2)
    assert sorted(r.path.rsplit("/", 2)[-2] + "/" + r.path.rsplit("/", 1)[-1] for r in few.collect()) == ["a/1.json", "a/2.json", "b/1.json", "b/2.json"]
    again = ingest.load_tree(spark, f"file://{tmp_path}", "crossref", done.catalog, "new")
    assert again.counters["inserted"] == 0 and again.counters["skipped"] == 2 and again.counters["rejected"] == 6
    with pytest.raises(ValueError):
        ingest.load_tree(spark, f"file://{tmp_path}", "crossref", done.catalog, "all")


def test_undo_restores_works_without_authorships(spark):
    rows = "work_id long, person_id long, role string, position int, affiliation_id long, is_corresponding int"
    now = spark.createDataFrame([(1, 1, "EDITOR", 1, None, 0), (2, 2, "AUTHOR", 1, None, 0), (3, 3, "AUTHOR", 1, None, 0)], rows)
    before = spark.createDataFrame([(1, [(1, "AUTHOR", 1, None, 0)]), (2, None)], "work_id long, rows array<struct<person_id: long, role: string, position: int, affiliation_id: long, is_corresponding: int>>")
    assert sorted((r.work_id, r.role) for r in load.undo_roles(now, before).collect()) == [(1, "AUTHOR"), (3, "AUTHOR")]


def test_misspelt_names_against_all_pairs(spark):
    def edits(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            row, last = [i], row
            for j, y in enumerate(b, 1):
                row.append(min(last[j] + 1, row[j - 1] + 1, last[j - 1] + (x != y)))
        return row[-1]

    rng = random.Random(3)
    known = ["Peru", "Chad", "Iran", "Iraq", "Mali", "Oman", "Brazil", "Germany", "Guatemala", "Mozambique", "Côte d'Ivoire", "Austria", "Australia", "UK"]
    names = [None, "", "  peru ", "uk", "ux"]
    for k in known:
        for _ in range(25):
            s = list(k)
            for _ in range(rng.randint(0, 3)):
                at = rng.randrange(len(s) + 1)
                s[at : at + rng.choice([0, 1])] = rng.choice(["", "x", "a"])
            names.append("".join(s))
    allowed = lambda k: 0 if len(k) < 4 else 1 if len(k) < 8 else 2
    want = {}
    for n in {x for x in names if x and x.strip()}:
        near = [(e, k) for k in known if (e := edits(n.strip().lower(), k.lower())) <= allowed(k)]
        if near:
            want[n] = min(near)
    df, table = spark.createDataFrame([(x,) for x in names], "name string"), spark.createDataFrame([(k,) for k in [*known, None]], "match string")
    assert {r.name: (r.edits, r.match) for r in places.closest_names(df, table).collect()} == want


def test_codes_of_misspelt_countries(spark):
    codes = spark.createDataFrame([("Germany", "DE"), ("Brazil", "BR"), ("Iran, Islamic Republic of", "IR")], "name string, code string")
    rows = spark.createDataFrame([(1, "germany"), (2, "Gemany"), (3, "Brasil"), (4, "Iran"), (5, "Atlantis"), (6, None)], "id int, c string")
    got = {r.id: r.country_code for r in places.country_codes(rows, "c", codes, misspelt=True).collect()}
    assert got == {1: "DE", 2: "DE", 3: "BR", 4: "IR", 5: None, 6: None}
    assert {r.id: r.country_code for r in places.country_codes(rows, "c", codes).collect()} == {1: "DE", 2: None, 3: None, 4: "IR", 5: None, 6: None}


def test_title_split_and_deletion_of_odd_rows(spark):
    works = spark.createDataFrame([(1, "a: b: c", None), (2, ": x", None), (3, "x :", None), (4, None, None), (5, "a: b", "own"), (6, "", None), (7, "no", None)], "id long, title string, subtitle string")
    out = cleanup.run({"works": works}, ("title_subtitle",))[0]["works"]
    assert {r.id: (r.title, r.subtitle) for r in out.collect()} == {1: ("a", "B: c"), 2: (": x", None), 3: ("x :", None), 4: (None, None), 5: ("a: b", "own"), 6: ("", None), 7: ("no", None)}
    left, gone = delete_works.delete_works({"works": works})
    assert {r.id: r.rule for r in gone.collect()} == {4: "placeholder", 6: "placeholder"} and left["works"].count() == 5
    assert delete_works.delete_works({"works": works.limit(0)})[1].count() == 0


def test_pieces_of_names_are_not_grouped(spark):
    """Some sixty rows a name: told apart, they would be a hash table of all pieces in each task."""
    near = places.closest_names(spark.createDataFrame([("Frence",)], "name string"), spark.createDataFrame([("France",)], "match string"))
    assert [tuple(r) for r in near.collect()] == [("Frence", "France", 1)]
    groups = [x for x in near._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Aggregate [" in x]
    assert groups and not any("letters" in x for x in groups)
