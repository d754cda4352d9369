"""Sinks read by other readers, and the state table when a writer breaks off."""

import csv
import glob
import json

import pytest

from corpuscle.operators import graph
from corpuscle.sources import io
from corpuscle.streaming import ingest

PAGE = "sha256 string, page_number int, status string, pipeline_version string, seq long"


@pytest.fixture
def state(spark, tmp_path):
    return ingest.StateTable(spark, f"file://{tmp_path}/state", PAGE)


def rows(table):
    return sorted(map(tuple, table.read().collect()))


def test_state_survives_a_writer_that_dies_before_its_mark(spark, state, monkeypatch):
    assert state.read().count() == 0
    state.replace(spark.createDataFrame([("a", 1, "done", "1", 1)], PAGE))
    before = rows(state)
    with monkeypatch.context() as m:
        m.setattr(ingest, "put", lambda *_: (_ for _ in ()).throw(OSError("killed")))
        with pytest.raises(OSError, match="killed"):
            state.replace(spark.createDataFrame([("b", 1, "done", "1", 2)], PAGE))
    assert rows(state) == before
    merge = ingest.merge_pages(state)
    batch = spark.createDataFrame([("a", 1, "error", "1", 3), ("b", 1, "done", "1", 2)], PAGE)
    for _ in range(2):  # a batch that runs twice changes nothing more
        merge(batch, 0)
        assert rows(state) == [("a", 1, "done", "1", 1), ("b", 1, "done", "1", 2)]


def test_state_keeps_the_version_of_running_readers(spark, state):
    for n in range(4):
        late = state.read()
        state.replace(spark.createDataFrame([("a", 1, "done", "1", n)], PAGE))
        assert late.count() == min(n, 1), "a reader from before still finds its version"
    assert len(io.names(spark, f"{state.folder}/CURRENT")) == 2


def test_sinks_are_read_by_others(spark, tmp_path):
    df = spark.createDataFrame([(1, 'a "b", c', [1.5, None], float("nan")), (2, None, None, float("-inf"))], "id int, t string, xs array<double>, x double")
    io.write_json(df, f"file://{tmp_path}/j")
    found = [json.loads(line) for f in glob.glob(f"{tmp_path}/j/*.json") for line in open(f)]
    assert sorted(found, key=lambda r: r["id"]) == [{"id": 1, "t": 'a "b", c', "xs": [1.5, None], "x": None}, {"id": 2, "t": None, "xs": None, "x": None}]
    io.write_csv(df.select("id", "t"), f"file://{tmp_path}/c")
    found = [r for f in glob.glob(f"{tmp_path}/c/*.csv") for r in csv.DictReader(open(f, newline=""))]
    assert sorted(r["t"] for r in found) == ["", 'a "b", c']
    io.write_documents(df.select("id", "t").where("id = 1"), f"file://{tmp_path}/d", "id", "t")
    assert open(glob.glob(f"{tmp_path}/d/id=1/*.txt")[0]).read() == 'a "b", c\n'


def test_triples_and_graphs_are_valid(spark, tmp_path):
    long = "x" * 5000
    t = spark.createDataFrame([(f"urn:c:{long}", "rdfs:label", 'say "hi"\\\n', "literal", None), ("_:" + "f" * 300, "slo:weight", "0.5", "literal", "xsd:double")], "s string, p string, o string, o_kind string, datatype string")
    lines = sorted(r["value"] for r in io.ntriples(t).collect())
    assert lines[0] == f'<urn:c:{long}> <http://www.w3.org/2000/01/rdf-schema#label> "say \\"hi\\"\\\\\\n" .'
    assert lines[1] == f"_:b{'f' * 300} <urn:corpus:ontology#weight> " + '"0.5"^^<http://www.w3.org/2001/XMLSchema#double> .'
    node = {r["@id"]: r for r in (json.loads(x["value"]) for x in io.jsonld(t).collect())}
    assert node[f"urn:c:{long}"]["rdfs:label"] == [{"@value": 'say "hi"\\\n'}]
    nodes = spark.createDataFrame([("a", "A", "Place"), ("b", "B", "Place")], "node_id string, label string, type string")
    edges = spark.createDataFrame([("a", "b", "x", 0.5, None), ("a", "z", "x", 0.5, None)], "src string, dst string, type string, combined double, quality_weight double")
    io.write_sigma(nodes, edges, f"file://{tmp_path}/s")
    shown = [json.loads(line) for f in glob.glob(f"{tmp_path}/s/edges/*.json") for line in open(f)]
    assert shown == [{"source": "a", "target": "b", "type": "x", "weight": 0.5}]


def test_query_texts(spark):
    t = spark.createDataFrame([("u:a", "rdf:type", "slo:X", "uri", None), ("u:a", "rdfs:label", "A 1", "literal", None), ("u:b", "rdfs:label", "B", "literal", None)], "s string, p string, o string, o_kind string, datatype string")
    got = graph.select(t, 'select ?x where { ?x a slo:X ; rdfs:label "A 1" }').collect()
    assert [r["x"] for r in got] == ["u:a"]
    assert graph.select(t, "SELECT * WHERE { ?x rdfs:label ?l . } LIMIT 1").count() == 1
    assert sorted(graph.select(t, "SELECT * WHERE { <u:b> rdfs:label ?l }").columns) == ["l"]
    for bad in ("DROP GRAPH x", "select ?x where { ?x rdfs:label }", "select ?x", "insert data { <a> <b> <c> }"):
        with pytest.raises(ValueError):
            graph.select(t, bad)
