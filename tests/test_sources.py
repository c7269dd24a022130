"""Scans, sinks, publish and incremental ingest on real files."""

import gzip
import json
import os
import pathlib
import subprocess
import sys
import threading

import pytest
from pyspark.sql import functions as F

from reelhouse import session
from reelhouse.operators import filters
from reelhouse.operators.quality import IntegrityError
from reelhouse.plans import star
from reelhouse.schemas import WAREHOUSE
from reelhouse.sources import commits, readers, sinks
from reelhouse.streaming.incremental import (
    ingest_new_files,
    ingest_since_marks,
    ingest_warehouse,
    ingested,
    loaded,
    newer_than_marks,
)

ROOT = pathlib.Path(__file__).resolve().parents[1]


def test_category_folders(spark, tmp_path):
    for folder, name, body in (
        ("GAMES", "a.json", json.dumps({"game_title": "A", "media_details": {"genres": ["x"]},
                                        "critic_reviews": {"PC": [{"author": "me", "rating": 5}]}}, indent=2)),
        ("TV_SHOWS", "b.json", json.dumps({"tv_title": "B"})),
        ("MOVIES", "c.json", json.dumps({"title": "C"})),
        ("MOVIES", "bad.json", "{oops"),
        ("MOVIES", "note.txt", "not a document"),
    ):
        (tmp_path / folder).mkdir(exist_ok=True)
        (tmp_path / folder / name).write_text(body)
    (tmp_path / "stray.json").write_text("{}")
    docs = readers.category_json(spark, str(tmp_path)).collect()
    kinds = {(d.title or d.tv_title or d.game_title): (d.category, d.media_type, d.section_type) for d in docs}
    assert kinds == {
        "A": ("GAMES", "Video Game", "Platform"),
        "B": ("TV_SHOWS", "TV Series", "Season"),
        "C": ("MOVIES", "Movie", "Display"),
        None: ("MOVIES", "Movie", "Display"),
    }
    assert [d._corrupt_record for d in docs if d._corrupt_record] == ["{oops"]
    assert next(d for d in docs if d.game_title).critic_reviews["PC"][0].rating == 5


def test_gzipped_tsv(spark, tmp_path):
    lines = [
        "nconst\tprimaryName\tbirthYear\tdeathYear\tprimaryProfession\tknownForTitles",
        'n1\t"Q" x\t\\N\t\\N\tactor\t\\N',
        "n2\tNone\t1950\t\\N\t\\N\t\\N",
        "n3\tNA\\b\t\\N\t\\N\t\\N\t\\N",
        "n4\t\\N\t\\N\t\\N\t\\N\t\\N",
    ]
    path = tmp_path / "name.basics.tsv.gz"
    path.write_bytes(gzip.compress("\n".join(lines).encode()))
    got = readers.tsv(spark, str(path), "name.basics", ["nconst", "primaryName"])
    assert got.rdd.getNumPartitions() > 1
    assert {r.nconst: r.primaryName for r in got.collect()} == {
        "n1": '"Q" x', "n2": "None", "n3": "NA\\b", "n4": None,
    }


def test_delimited_with_whitelist_and_dropped_column(spark, tmp_path):
    (tmp_path / "in.csv").write_text("id;status;temp\n1;active;x\n2;gone;y\n3;active;z\n")
    got = readers.delimited(
        spark, str(tmp_path / "in.csv"), "id string, status string, temp string",
        drop=["temp"], groups=[{"status": "active"}],
    )
    assert got.columns == ["id", "status"]
    assert sorted(r.id for r in got.collect()) == ["1", "3"]


def test_multi_table_json(spark, tmp_path):
    (tmp_path / "t.json").write_text(json.dumps(
        {"GENRES": [{"id": "g", "genre_title": "x"}], "DIM_TIME": [{"id": "t", "year": 1}, {"id": "u"}]}, indent=1))
    wanted = {n: WAREHOUSE[n].schema for n in ("GENRES", "DIM_TIME")}
    got = readers.multi_table_json(spark, str(tmp_path / "t.json"), wanted)
    assert got["GENRES"].collect() == [("g", "x")]
    assert sorted(r.id for r in got["DIM_TIME"].collect()) == ["t", "u"]


def test_rows(spark):
    got = readers.rows(spark, {"a": {"x": 1}, "b": {"x": 2}}, "x int, id string", id_col="id")
    assert sorted(map(tuple, got.collect())) == [(1, "a"), (2, "b")]
    with pytest.raises(ValueError):
        readers.rows(spark, [], "x int")


def test_limit_per_group_with_a_hot_group(spark):
    df = spark.createDataFrame([("hot", i) for i in range(1000)] + [("cold", 1)], "g string, i int")
    got = readers.limit_per_group(df, ["g"], ["i"], 20).collect()
    assert len(got) == 21 and max(r.i for r in got if r.g == "hot") == 19


def small_warehouse(spark, genre="Action"):
    rows = {
        "COMPANIES": [("c", "developer", "Co")],
        "GENRES": [("g", genre)],
        "ROLES": [("r", "P", "actor", "Hero")],
        "DIM_MEDIA_INFO": [("m", "Movie", None, "T", "2000", 90.0, None, None)],
        "DIM_SECTION": [("s", "Display", None, "_default")],
        "DIM_REVIEWER": [("w", None, True, "me")],
        "DIM_TIME": [("t", 2000, 1, 2)],
        "BRIDGE_MEDIA_ROLE": [("m", "r", 1.0)],
        "BRIDGE_MEDIA_GENRE": [("m", "g", 1.0)],
        "BRIDGE_MEDIA_COMPANY": [("m", "c", 1.0)],
        "FACT_REVIEWS": [("w", "t", "s", "m", 80)],
    }
    return {n: spark.createDataFrame(rows[n], t.schema) for n, t in WAREHOUSE.items()}


def test_publish_is_all_or_nothing(spark, tmp_path):
    root = str(tmp_path / "wh")
    assert sinks.create_schema(spark, root)["GENRES"].count() == 0
    first = sinks.publish(spark, small_warehouse(spark), root)
    with pytest.raises(IntegrityError, match="GENRES: not null"):
        sinks.publish(spark, small_warehouse(spark, genre=None), root)
    orphaned = small_warehouse(spark)
    orphaned["DIM_TIME"] = orphaned["DIM_TIME"].where("id = 'none'")
    with pytest.raises(IntegrityError, match="foreign key time_id"):
        sinks.publish(spark, orphaned, root)
    doubled = small_warehouse(spark)
    doubled["ROLES"] = doubled["ROLES"].union(doubled["ROLES"])
    with pytest.raises(IntegrityError, match="ROLES: primary key"):
        sinks.publish(spark, doubled, root)
    assert sinks.current_version(spark, root) == first
    assert sinks.open_warehouse(spark, root)["GENRES"].collect() == [("g", "Action")]
    assert sinks.publish(spark, small_warehouse(spark, "Drama"), root) != first
    assert sinks.create_schema(spark, root)["GENRES"].collect() == [("g", "Drama")]


def test_dashboard_sql_text_agrees_with_the_plans(spark):
    from reelhouse.plans import dashboards as d

    star = small_warehouse(spark)
    for name, df in star.items():
        df.createOrReplaceTempView(name)
    args = {"avg_by_company": {"roles": ["developer"]}, "avg_by_name_match": {"word": "Her"}}
    plans = {
        "avg_by_genre_platform": d.avg_by_genre_platform(star, ("Season",)),
        "avg_by_company": d.avg_by_company(star),
        "avg_by_name_match": d.avg_by_name_match(star, "Her"),
        "company_roles": d.company_roles(star),
    }
    plans |= {
        "avg_by_year": d.avg_by_year(star, critics=True),
        "best_genre_per_company": d.best_genre_per_company(star),
        "company_score_bands": d.company_score_bands(star),
    }
    args |= {"avg_by_year": {"critics": True}, "company_score_bands": {"roles": ["developer"]}}
    assert set(plans) == set(d.SQL)
    for name, text in d.SQL.items():
        text = text.replace("('Season', 'Display')", "('Season')")
        got = [tuple(r) for r in spark.sql(text, args=args.get(name, {})).collect()]
        want = [tuple(r) for r in plans[name].collect()]
        assert sorted(got, key=repr) == sorted(want, key=repr), name


def test_new_files_are_ingested_once(spark, tmp_path):
    source, target, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    for batch in (range(3), range(3, 5)):
        spark.createDataFrame([(i,) for i in batch], "id int").write.mode("append").json(source)
        for _ in range(2):
            ingest_new_files(spark, source, "id int", target, state, "json", files_per_batch=1)
    assert sorted(r.id for r in ingested(spark, target).collect()) == [0, 1, 2, 3, 4]


def test_csv_pipe_puts_ids_first(spark, tmp_path):
    sinks.csv_pipe(spark.createDataFrame([("é", 1)], "name string, id int"), str(tmp_path / "o"))
    files = [f.read_text(encoding="utf-8") for f in (tmp_path / "o").glob("*.csv")]
    assert all(text.startswith("id|name\n") for text in files)
    back = spark.read.option("sep", "|").option("header", True).csv(str(tmp_path / "o")).collect()
    assert [tuple(r) for r in back] == [("1", "é")]


def test_row_callback_sees_plain_values(spark):
    seen = [(2**53 + 1, "a"), (None, None), (3, "b")]
    df = spark.createDataFrame(seen, "id long, name string")
    kept = filters.row_callback(
        df,
        keep=lambda r: r["id"] is None or r["id"] > 3,
        convert=lambda r: {"id": r["id"], "kind": type(r["id"]).__name__},
        schema="id long, kind string",
    )
    assert {tuple(r) for r in kept.collect()} == {(2**53 + 1, "int"), (None, "NoneType")}


def test_a_crash_before_the_version_is_named_leaves_the_earlier_one(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    assert sinks.current_version(spark, root) is None
    commits.commit(spark, root, lambda before: {"name": "one"})

    def crash(*_):
        raise OSError("before the name")

    with monkeypatch.context() as m:
        m.setattr(commits, "_named", crash)
        with pytest.raises(OSError):
            commits.commit(spark, root, lambda before: {"name": "two"})
    assert commits.latest(spark, root) == (1, {"name": "one"})
    commits.commit(spark, root, lambda before: {"name": "three", "after": before["name"]})
    assert commits.latest(spark, root) == (2, {"name": "three", "after": "one"})


def test_no_version_is_lost_between_writers(spark, tmp_path):
    root, calls = str(tmp_path), []

    def add(name):
        def make(before):
            calls.append(name)
            return {"names": [*before.get("names", []), name]}

        commits.commit(spark, root, make)

    threads = [threading.Thread(target=add, args=(i,)) for i in range(6)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    number, entry = commits.latest(spark, root)
    assert number == 6 and sorted(entry["names"]) == list(range(6))
    assert [commits.read(spark, root, n)["names"] for n in range(1, 7)] == [
        entry["names"][:n] for n in range(1, 7)
    ]
    assert len(calls) >= 6
    assert not commits.create_absent(spark, f"{root}/_log/{6:020d}.json", "{}")
    assert commits.latest(spark, root) == (6, entry)


def test_an_appended_batch_counts_once(spark, tmp_path):
    root = str(tmp_path)
    first = small_warehouse(spark)
    assert sinks.append(spark, first, root, ("docs", 0)) == 1
    assert sinks.append(spark, first, root, ("docs", 0)) == 1
    more = small_warehouse(spark, "Other name, same key")
    one = lambda t, *row: spark.createDataFrame([row], WAREHOUSE[t].schema)
    more["GENRES"] = more["GENRES"].union(one("GENRES", "g2", "Drama"))
    more["DIM_MEDIA_INFO"] = more["DIM_MEDIA_INFO"].union(
        one("DIM_MEDIA_INFO", "m2", "Movie", None, "Two", "2001", None, None, None)
    )
    # The known medium gets no second genre, which would break its weights; the new one does.
    more["BRIDGE_MEDIA_GENRE"] = one("BRIDGE_MEDIA_GENRE", "m", "g2", 1.0).union(
        one("BRIDGE_MEDIA_GENRE", "m2", "g2", 1.0)
    )
    more["FACT_REVIEWS"] = one("FACT_REVIEWS", "w", "t", "s", "m2", 70).union(more["FACT_REVIEWS"])
    assert sinks.append(spark, more, root, ("docs", 1)) == 2
    now = sinks.open_warehouse(spark, root)
    assert {tuple(r) for r in now["GENRES"].collect()} == {("g", "Action"), ("g2", "Drama")}
    assert {r.media_id for r in now["BRIDGE_MEDIA_GENRE"].collect()} == {"m", "m2"}
    assert now["BRIDGE_MEDIA_GENRE"].where("media_id = 'm'").count() == 1
    assert sorted(r.rating for r in now["FACT_REVIEWS"].collect()) == [70, 80]
    # An orphan is refused and nothing is added.
    broken = dict(more, FACT_REVIEWS=one("FACT_REVIEWS", "w", "t", "s", "nobody", 1))
    with pytest.raises(IntegrityError, match="foreign key media_info_id"):
        sinks.append(spark, broken, root, ("docs", 2))
    assert sinks.current_version(spark, root) == 2


def test_a_stream_that_crashes_before_its_commit_loads_the_same_tables(spark, tmp_path, monkeypatch):
    landing = tmp_path / "landing"
    for i, category in enumerate(["GAMES", "GAMES", "MOVIES", "TV_SHOWS"]):
        folder = landing / category
        folder.mkdir(parents=True, exist_ok=True)
        field = {"GAMES": "game_title", "MOVIES": "title", "TV_SHOWS": "tv_title"}[category]
        doc = {
            field: f"Name {i}",
            "media_details": {"genres": ["Action", f"G{i}"], "initial_release_date": "Nov 1, 1999"},
            "critic_reviews": {"_default": [
                {"author": "Ann", "company": "Mag", "quote": "", "rating": 50 + i, "post_date": "2020-01-05",
                 "spoiler": False, "isCritic": True}]},
            "user_reviews": {},
        }
        (folder / f"{i}.json").write_text(json.dumps(doc))

    def run(name):
        ingest_warehouse(
            spark, str(landing), str(tmp_path / name), str(tmp_path / f"{name}-state"),
            star.document_tables, files_per_batch=1,
        )

    def tables(name):
        now = sinks.open_warehouse(spark, str(tmp_path / name))
        return {t: sorted(map(str, df.collect())) for t, df in now.items()}

    run("plain")
    named, seen = commits._named, []

    def crash_at_the_second(*args):
        seen.append(args)
        if len(seen) == 2:
            raise OSError("crash between write and version")
        return named(*args)

    with monkeypatch.context() as m:
        m.setattr(commits, "_named", crash_at_the_second)
        with pytest.raises(Exception, match="crash between"):
            run("crashed")
    run("crashed")
    run("crashed")
    assert tables("crashed") == tables("plain")
    assert len(tables("plain")["DIM_MEDIA_INFO"]) == 4 and len(tables("plain")["GENRES"]) == 5
    number, entry = commits.latest(spark, str(tmp_path / "crashed"))
    assert (number, entry["batches"]) == (4, {"documents": 3})


def test_only_files_before_the_mark_are_read(spark, tmp_path):
    landing, root, opened = tmp_path / "in", str(tmp_path / "out"), []

    def put(category, *names):
        (landing / category).mkdir(parents=True, exist_ok=True)
        for name in names:
            (landing / category / f"{name}.json").write_text(json.dumps({"id": f"{category}{name}"}))

    def read(paths):
        opened.append(sorted(p.rsplit("/", 2)[1] + p.rsplit("/", 1)[1] for p in paths))
        return spark.read.schema("id string").json(list(paths))

    put("GAMES", "001", "002")
    put("MOVIES", "005")
    assert ingest_since_marks(spark, str(landing), root, read) == 1
    assert ingest_since_marks(spark, str(landing), root, read) == 1
    put("GAMES", "003")
    put("TV", "001")
    assert ingest_since_marks(spark, str(landing), root, read) == 2
    assert opened == [["GAMES001.json", "GAMES002.json", "MOVIES005.json"], ["GAMES003.json", "TV001.json"]]
    assert sorted(r.id for r in loaded(spark, root).collect()) == [
        "GAMES001", "GAMES002", "GAMES003", "MOVIES005", "TV001"]

    def fail(paths):
        raise OSError("unreadable")

    put("GAMES", "004")
    with pytest.raises(OSError):
        ingest_since_marks(spark, str(landing), root, fail)
    assert ingest_since_marks(spark, str(landing), root, read) == 3
    assert opened[-1] == ["GAMES004.json"]


def test_a_category_without_its_marked_item_is_new_as_a_whole(spark):
    listing = spark.createDataFrame(
        [("a", "x", 3), ("a", "y", 2), ("a", "z", 1), ("b", "p", 9), ("b", "q", 8), (None, "n", 1)],
        "category string, item string, place int")
    marks = spark.createDataFrame([("a", "y"), ("b", "gone")], "category string, item string")
    new = newer_than_marks(listing, marks, "category", "item", F.col("place"))
    assert sorted(r["item"] for r in new.collect()) == ["n", "p", "q", "x"]


def graph_rows(spark, ids, value):
    nodes = spark.createDataFrame(
        [("M", i, {"v": value}, 1) for i in ids] + [("G", "g", {}, 1)],
        "_GRAPH_NODE_LABEL string, _GRAPH_NODE_ID string, attrs map<string,string>, seq int")
    links = spark.createDataFrame(
        [("M", i, "has", "G", "g", {"v": value}, 1) for i in ids],
        "_GRAPH_SRC_LABEL string, _GRAPH_SRC_NODE_ID string, _GRAPH_LINK_LABEL string, "
        "_GRAPH_TRGT_LABEL string, _GRAPH_TRGT_NODE_ID string, attrs map<string,string>, seq int")
    return nodes, links


def test_an_upsert_rewrites_touched_buckets_only(spark, tmp_path):
    root = str(tmp_path)
    sinks.upsert_graph(spark, *graph_rows(spark, [f"m{i}" for i in range(400)], "1"), root, buckets=16)
    before = commits.latest(spark, root)[1]
    assert len(before["nodes"]) == 17 and len(before["links"]) == 16
    sinks.upsert_graph(spark, *graph_rows(spark, ["m7"], "2"), root)
    after = commits.latest(spark, root)[1]
    changed = {t: [b for b in after[t] if after[t][b] != before[t].get(b)] for t in ("nodes", "links")}
    # The medium's bucket, the genre's, and the link's.
    assert len(changed["nodes"]) == 2 and len(changed["links"]) == 1
    written = {t: sum(f.stat().st_size for b in changed[t] for f in (tmp_path / after[t][b]).glob("*.parquet"))
               for t in ("nodes", "links")}
    whole = {t: sum(f.stat().st_size for p in after[t].values() for f in (tmp_path / p).glob("*.parquet"))
             for t in ("nodes", "links")}
    assert written["nodes"] < whole["nodes"] / 4 and written["links"] < whole["links"] / 8
    nodes, links = sinks.open_graph(spark, root)
    values = {r._GRAPH_NODE_ID: r.attrs.get("v") for r in nodes.collect()}
    assert len(values) == 401 and values["m7"] == "2" and values["m8"] == "1"
    assert links.count() == 400


def test_two_upserts_at_once_both_survive(spark, tmp_path):
    root = str(tmp_path)
    rows = [graph_rows(spark, [f"{w}{i}" for i in range(20)], w) for w in "ab"]
    threads = [threading.Thread(target=sinks.upsert_graph, args=(spark, *r, root, 4)) for r in rows]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    nodes, links = sinks.open_graph(spark, root)
    assert sinks.current_version(spark, root) == 2
    assert nodes.count() == 41 and links.count() == 40


def test_executors_get_the_package(tmp_path):
    """A job whose Python workers start in another folder, without any path set."""
    code = f"""
import sys
sys.path.insert(0, {str(ROOT)!r})
from reelhouse.session import local_session
from reelhouse.operators import pages
spark = local_session(2)
df = spark.createDataFrame([(1, "<nav><a href='/x'>x</a></nav>")], "page_id long, html string")
assert pages.parsed(df).count() == 1
pages.parsed(df).collect()
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True)
    assert done.returncode == 0, done.stderr[-2000:]


def test_a_stream_leaves_gzipped_documents_and_tables_and_no_staged_rows(spark, tmp_path, monkeypatch):
    """What is staged for a batch goes with it, so that the folders do not add up over the batches."""
    monkeypatch.setattr(session, "shared_dir", lambda spark: str(tmp_path / "shared"))
    landing, root, state = (str(tmp_path / n) for n in ("landing", "wh", "state"))
    review = "struct('Ann' as author, 'Mag' as company, '' as quote, 50 as rating, '2020-01-05' as post_date, true as isCritic)"
    docs = spark.range(0, 300, numPartitions=2).selectExpr(
        "'MOVIES' as category", "concat('Name ', id) as title",
        "struct(array('Action', concat('G', id % 7)) as genres, 'Nov 1, 1999' as release_date) as media_details",
        f"map('_default', transform(sequence(1, 20), i -> {review})) as critic_reviews",
    )
    sinks.json_docs(docs, landing)
    files = list(pathlib.Path(landing).glob("*/part-*"))
    assert len(files) == 2 and all(f.name.endswith(".json.gz") for f in files)
    assert sum(f.stat().st_size for f in files) < 300 * 20 * 10
    ingest_warehouse(spark, landing, root, state, star.document_tables, multi_line=False, files_per_batch=1)
    now = {n: df.count() for n, df in sinks.open_warehouse(spark, root).items()}
    assert (now["DIM_MEDIA_INFO"], now["BRIDGE_MEDIA_GENRE"], now["GENRES"], now["FACT_REVIEWS"]) == (300, 600, 8, 300)
    assert commits.latest(spark, root)[1]["batches"] == {"documents": 1}
    assert not list((tmp_path / "shared").rglob("*.parquet"))


def test_rows_that_are_there_are_left_out_of_every_table(spark, tmp_path):
    """Ids that are digests and others; a batch that is all there, in part, and not at all."""
    root = str(tmp_path)
    digest = "0123456789abcdef" * 2

    def batch(media, genres):
        made = small_warehouse(spark)
        info = [(m, "Movie", None, m, "2000", 90.0, None, None) for m in media]
        made["DIM_MEDIA_INFO"] = spark.createDataFrame(info, WAREHOUSE["DIM_MEDIA_INFO"].schema)
        made["GENRES"] = spark.createDataFrame([(g, g) for g in genres], WAREHOUSE["GENRES"].schema)
        pairs = [(m, g, 1 / len(genres)) for m in media for g in genres]
        made["BRIDGE_MEDIA_GENRE"] = spark.createDataFrame(pairs, WAREHOUSE["BRIDGE_MEDIA_GENRE"].schema)
        for name, row in (("BRIDGE_MEDIA_ROLE", ("r", 1.0)), ("BRIDGE_MEDIA_COMPANY", ("c", 1.0))):
            made[name] = spark.createDataFrame([(m, *row) for m in media], WAREHOUSE[name].schema)
        facts = [("w", "t", "s", m, i) for i, m in enumerate(media)]
        made["FACT_REVIEWS"] = spark.createDataFrame(facts, WAREHOUSE["FACT_REVIEWS"].schema)
        return made

    def rows(name):
        return sorted(tuple(r) for r in sinks.open_warehouse(spark, root)[name].collect())

    sinks.append(spark, batch([digest, "m"], ["g"]), root)
    before = {n: rows(n) for n in WAREHOUSE}
    sinks.append(spark, batch([digest, "m"], ["g"]), root)
    assert {n: rows(n) for n in WAREHOUSE} == before
    sinks.append(spark, batch(["m", "n"], ["g", digest]), root)
    assert rows("BRIDGE_MEDIA_GENRE") == [(digest, "g", 1.0), ("m", "g", 1.0), ("n", digest, 0.5), ("n", "g", 0.5)]
    assert [r[3:] for r in rows("FACT_REVIEWS")] == [(digest, 0), ("m", 1), ("n", 1)]
    assert [r[0] for r in rows("GENRES")] == [digest, "g"] and len(rows("DIM_MEDIA_INFO")) == 3
    folders = {p.parent.relative_to(tmp_path).as_posix() for p in tmp_path.rglob("part-*.parquet")}
    assert folders == {f for paths in commits.latest(spark, root)[1]["tables"].values() for f in paths}
