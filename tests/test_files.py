"""File round trips, the prepare pipeline, pages and streams on inline rows."""

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from voxspark import schemas as S
from voxspark.functions import text as X
from voxspark.operators import pages, profile
from voxspark.operators.relational import cast_columns
from voxspark.plans import places, prepare, retrieval
from voxspark.sources import readers, writers
from voxspark.streaming import ingest

HEADER = ",".join(f'"{c}"' for c in S.REVIEW_FIELDS)


def review(i, **fields):
    base = {
        "token": "t", "review_id": f"r{i}", "retrieval_date": "2025-02-16 10:00:00", "rating": "4.0", "rating_max": "5.0",
        "relative_date": "uma semana atrás", "likes": "-1", "user_is_local_guide": "False", "errors": "[]",
    }
    row = {**base, **fields}
    return ",".join('"' + str(row.get(c, "")).replace('"', '""') + '"' for c in S.REVIEW_FIELDS)


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    root = tmp_path_factory.mktemp("collected")
    hotel_a = [
        HEADER,
        review(1, text='Disse "ótimo"\ne voltou, sim', other_ratings="Quartos : 4/5 Local : 5/5", user_url="https://x/contrib/" + "1" * 21 + "?hl=pt"),
        HEADER,
        review(2, text="", likes="3", user_is_local_guide="True", relative_date="um ano atrás"),
        review(2, text="de novo", retrieval_date="2025-02-17 10:00:00"),
    ]
    hotel_b = [HEADER, review(3, text="um dois três quatro cinco seis sete oito nove dez", rating="5.0", relative_date="2 meses atrás")]
    (root / "hotel-a.csv").write_text("\n".join(hotel_a) + "\n", encoding="utf-8")
    (root / "hotel-b.csv").write_text("\n".join(hotel_b) + "\n", encoding="utf-8")
    for stem, url, n in (("hotel-a", "u/a", 2), ("hotel-b", "u/b", -1)):
        meta = {
            "name": stem, "feature_id": "0x0:0x1", "retrieval_date": "2025-02-16 09:00:00.5", "place_name": stem.title(), "address": "Rua 1, Itu",
            "overall_rating": 4.5, "n_reviews": n, "topics": "", "url": url,
        }
        (root / f"{stem}.json").write_text(json.dumps(meta, indent=4), encoding="utf-8")
    (root / "places.txt").write_text(
        "\ndone,name,n_reviews,sort_by,hl,url,stars,city\n0,Hotel A,-1,newest,pt-br,u/a,4,Itu\n"
        '0,"Hotel, B",-1,newest,pt-br,u/b,3,Itu\n1,Hotel C,5,newest,pt-br,u/c,3,Itu\n0,Hotel D,5,newest,pt-br,u/d,3,Itu\n',
        encoding="utf-8",
    )
    return str(root)


def test_place_input_skips_blank_line_and_done(spark, folder):
    got = readers.read_place_input(spark, f"{folder}/places.txt")
    assert [r.name for r in got.orderBy("url").collect()] == ["Hotel A", "Hotel, B", "Hotel D"]
    assert readers.read_place_input(spark, f"{folder}/places.txt", pending_only=False).count() == 4
    assert dict(got.dtypes)["n_reviews_max"] == "bigint"


def test_reviews_drop_headers_and_keep_newlines(spark, folder):
    got = {(r.review_id, r.text): r for r in readers.read_reviews(spark, folder).collect()}
    assert len(got) == 4
    assert ("r1", 'Disse "ótimo"\ne voltou, sim') in got and ("r2", None) in got
    assert got[("r2", None)].file_name == "hotel-a"
    assert got[("r2", None)].rating == 4.0 and got[("r2", None)].retrieval_date == datetime(2025, 2, 16, 10)


def test_na_values(spark, folder):
    got = readers.read_reviews(spark, folder, na_values=["de novo"])
    assert got.where("text IS NULL").count() == 2


def test_meta(spark, folder):
    got = {r.file_name: r for r in readers.read_place_meta(spark, folder).collect()}
    assert got["hotel-a"].n_reviews == 2 and got["hotel-b"].n_reviews is None
    assert got["hotel-a"].retrieval_date_metadata == datetime(2025, 2, 16, 9, 0, 0, 500000)


def joined(spark, folder):
    return prepare.join_sources(
        readers.read_place_input(spark, f"{folder}/places.txt"), readers.read_place_meta(spark, folder),
        readers.read_reviews(spark, folder),
    )


def test_prepare_pipeline(spark, folder):
    rows = prepare.prepare(prepare.first_reviews(joined(spark, folder)))
    got = {r.review_id: r for r in rows.collect()}
    assert sorted(got) == ["r1", "r2", "r3"]
    assert got["r1"].review_date == datetime(2025, 2, 9, 10) and got["r2"].review_date == datetime(2024, 2, 16, 10)
    assert (got["r1"].rooms, got["r1"].locale, got["r1"].service) == (4.0, 5.0, None)
    assert got["r1"].user_id == "1" * 21 and got["r1"].name_input == "Hotel A"
    assert (got["r2"].likes, got["r1"].likes, got["r2"].user_is_local_guide) == (3.0, 0.0, 1.0)
    report = {r.name: r for r in prepare.place_report(rows).collect()}
    assert report["hotel-a"].review_id == 2 and report["hotel-a"].text == 1 and report["hotel-a"].text_percentage == 0.5
    assert report["hotel-a"].n_reviews_diff == 0


def test_index_table(spark, folder):
    rows = prepare.prepare(prepare.first_reviews(joined(spark, folder)))
    got = prepare.index_table({2: rows, 3: rows.where("review_id = 'r3'")})
    assert got.columns == list(S.INDEX_COLUMNS.values()) and len(got.columns) == 22
    row = got.head()
    assert (row.data_avaliacao, row.numero_palavras_avaliacao, row.avaliacao_recente) == ("2024-12-16", 10, 1.0)
    assert got.count() == 1


def test_text_table_and_hotel_documents(spark, folder):
    rows = prepare.prepare(prepare.first_reviews(joined(spark, folder)))
    docs = prepare.hotel_documents(prepare.text_table(rows, stopwords=[]))
    got = {r.name: r for r in docs.collect()}
    counts = {r.name: r for r in prepare.hotel_counts(prepare.text_table(rows, stopwords=[])).collect()}
    assert counts["hotel-a"].review_count == 2 and counts["hotel-a"].text_count == 1
    assert got["hotel-a"].text_normalized_sum == ' \n disse "otimo" e voltou, sim'
    assert got["hotel-a"].text_tokens_sum == [[], ["disse", "otimo", "voltou", "sim"]]


def test_duplicate_url_is_refused(spark, folder):
    inputs = readers.read_place_input(spark, f"{folder}/places.txt")
    with pytest.raises(Exception, match="is not unique"):
        prepare.join_sources(
            inputs.union(inputs), readers.read_place_meta(spark, folder), readers.read_reviews(spark, folder)
        ).collect()


def test_places(spark):
    states = spark.createDataFrame([("SP", "SÃO PAULO", "SÃO PAULO", "SUDESTE", "x"), ("AC", "ACRE", "RIO BRANCO", "NORTE", "x")], S.STATE_MAP)
    cols = "place_id string, name string, business_status string, reviews long, range string, state string, city string, location_link string, category string, subtypes string, n int"
    data = [
        ("p1", "A", "CLOSED", 50, None, "SP", "c", "u/0x0:0x1", "h", "h", 1),
        ("p1", "A", "OPERATIONAL", 60, None, "SP", "c", "u/0x0:0x1", "h", "h", 2),
        ("p2", "B", "OPERATIONAL", 4, None, "SP", "c", "u/0x0:0x2", "h", "h", 3),
        ("p3", "C", "OPERATIONAL", 5, "4 estrelas", "São Paulo", "c", "u/0x0:0x3", "h", "h", 4),
        ("p4", "C", "OPERATIONAL", 9, "$$", "AC", "c", "u/0x0:0x4", "h", "h", 5),
    ]
    kept = places.operational_places(spark.createDataFrame(data, cols), ["n"])
    assert [r.place_id for r in kept.collect()] == ["p4"]
    new = places.new_places(spark.createDataFrame(data[3:], cols), states, 2025)
    got = {r.google_id: r for r in new.collect()}
    assert (got["0x0:0x3"].sigla, got["0x0:0x3"].regiao, got["0x0:0x3"].stars) == ("SP", "SUDESTE", 4.0)
    assert (got["0x0:0x4"].sigla, got["0x0:0x4"].capital) == ("AC", "RIO BRANCO")
    old = spark.createDataFrame(
        [("C old", -1, "pt-br", "u/0x0:0x3", 7, 2.0, "SP", "r"), ("D", -1, "pt-br", "u/0x0:0x9", 8, 2.0, "sp", "r")],
        "name string, n_reviews int, hl string, url string, n_reviews_max long, stars double, state string, region string",
    )
    merged = {r.google_id: r.name for r in places.merged_places([new, places.old_places(old, states, 2023)]).collect()}
    assert merged == {"0x0:0x3": "C", "0x0:0x4": "C", "0x0:0x9": "D"}


def test_writers(spark, tmp_path):
    df = spark.createDataFrame([("a/b", 5, ' x "y"\n'), ("c", 150, "z")], "nome string, n int, t string")
    assert writers.save_df(df.where("false"), str(tmp_path), "e") is None
    assert writers.write_report(df.where("false"), str(tmp_path), "e") is None
    path = writers.save_df(df, str(tmp_path), "d", "ts")
    assert path.endswith("d_ts") and spark.read.parquet(path).count() == 2
    report = writers.write_report(df, str(tmp_path), "r")
    back = readers.read_union(spark, [report], "csv")
    assert sorted(r.t for r in back.collect()) == [' x "y"\n', "z"]
    writers.write_banded(df, "n", [100, 1000], f"{tmp_path}/bands")
    assert spark.read.parquet(f"{tmp_path}/bands").where("band = 'gte100_lt1000'").count() == 1
    writers.write_per_entity(df, "nome", f"{tmp_path}/per")
    assert sorted(r.nome for r in spark.read.parquet(f"{tmp_path}/per").collect()) == ["a/b", "c"]
    writers.write_named_texts(df, "nome", "t", f"{tmp_path}/texts")
    assert readers.read_named_texts(spark, f"{tmp_path}/texts").count() == 2


def test_dimensions_and_geojson(spark, tmp_path):
    (tmp_path / "dim.csv").write_text("name,latitude,longitude\nA,-29.6,-49.9\n", encoding="utf-8")
    assert tuple(readers.read_dim(spark, f"{tmp_path}/dim.csv", S.LAT_LONG).head()) == ("A", -29.6, -49.9)
    geo = {"type": "FeatureCollection", "features": [{"properties": {"sigla": s, "n": i}} for i, s in enumerate("AB")]}
    (tmp_path / "g.json").write_text(json.dumps(geo, indent=1), encoding="utf-8")
    got = readers.read_geojson_properties(spark, f"{tmp_path}/g.json")
    assert sorted((r.sigla, r.n) for r in got.collect()) == [("A", 0), ("B", 1)]


def test_pages(spark):
    html = (
        'x<div data-google-review-count="7" data-next-page-token="a1="><h1 class="Lhccdd">Hotel &amp; Cia Rua 1</h1>'
        '<span class="q ffUfxe">Rua 1</span><b class="Aq14fc">4,5</b><i class="z5jxId">1.057 comentários</i>'
        '<div class="rev"><span class="lTi8oc z3HNkc" aria-label="4,0 de 5,0"></span><div class="review-full-text">Bom  "lugar"</div></div></div>zz'
    )
    df = spark.createDataFrame([(1, html), (2, "<p>nada</p>")], "id int, html string").withColumn("html", pages.cut_body("html"))
    got = {r.id: r for r in pages.paging(pages.parse_places(df, "html"), "html").collect()}
    assert (got[1].address, got[1].place_name, got[1].overall_rating, got[1].n_reviews) == ("Rua 1", "Hotel & Cia", 4.5, 1057)
    assert (got[1].next_token, got[1].review_count, got[2].n_reviews, got[2].html) == ("a1=", 7, None, "<p>nada</p>")
    blocks = pages.html_blocks(df, "html", '<div class="rev">', ["id"])
    row = pages.parse_reviews(blocks, "block").collect()
    assert len(row) == 1 and (row[0].text, row[0].rating, row[0].likes) == ("Bom lugar", 4.0, 0.0)
    assert row[0].errors == [f"review {n}: not found" for n in ("relative_date", "user_name", "review_id")]


def test_context_block_text(spark):
    df = spark.createDataFrame(
        [("H", 4.0, "SUL", "RS", "C", "Resort", 4.5, 120, 5.0, 2.0, 1.0, 4.0, None, 3.0, "Bom")],
        "nome string, estrelas double, regiao string, estado string, cidade string, subcategoria string, classificacao_geral double, "
        "quantidade_avaliacoes long, nota_avaliacao double, curtidas_avaliacao double, usuario_guia_local double, nota_quartos double, "
        "nota_localizacao double, nota_servico double, text string",
    )
    got = df.select(retrieval.render_review(F.lit(1), F.lit(0.5)).alias("b")).head().b
    assert got == (
        " - Avaliação 1, Similaridade: 0.500\nHotel: H, 4 Estrelas.\nRegião:SUL; Estado:RS; Cidade:C\n"
        "Tipo:Resort; Classificação:4.5; Quantidade Avaliações:120\n"
        "Nota:5; Curtidas:2; Usuário é guia local; Nota Quartos:4; Nota Serviço:3\nAvaliação: Bom\n\n"
    )
    plain = df.select(retrieval.render_review(F.lit(2), None, with_hotel=False).alias("b")).head().b
    assert plain.startswith(" - Avaliação 2\nNota:5;")


def test_fill_does_not_scan_inserted_text(spark):
    df = spark.createDataFrame([("{b}", "x")], "a string, b string")
    got = df.select(retrieval.fill("<{a}|{b}|{a}>{c}", {"a": F.col("a"), "b": F.col("b")}).alias("t")).head().t
    assert got == "<{b}|x|{b}>{c}"


def test_stream_equals_batch_and_runs_again(spark, folder, tmp_path):
    for delay in (None, "30 days"):
        out, run = f"{tmp_path}/out-{delay}", f"{tmp_path}/run-{delay}"
        for _ in range(2):
            stream = ingest.review_stream(spark, folder)
            ingest.ingest(stream, out, run, "review_id", "retrieved_at", delay).awaitTermination()
        got = [r.review_id for r in spark.read.parquet(out).collect()]
        assert sorted(got) == ["r1", "r2", "r3"]
    again = ingest.ingest(
        ingest.review_stream(spark, folder), f"{tmp_path}/out-30 days", f"{tmp_path}/new-run", "review_id", "retrieved_at", "30 days"
    )
    again.awaitTermination()
    assert spark.read.parquet(f"{tmp_path}/out-30 days").count() == 3


def test_running_summary(spark, folder, tmp_path):
    errors = (F.col("errors") != "[]").cast("int")
    summary = ingest.running_summary(ingest.review_stream(spark, folder), "file_name", errors, "retrieval_date")
    got = {r.file_name: r for r in ingest.run_to_folder(summary, "file_name", f"{tmp_path}/s", f"{tmp_path}/c").collect()}
    assert (got["hotel-a"].n_scraped, got["hotel-a"].n_errors, got["hotel-b"].n_scraped) == (3, 0, 1)


def test_running_summary_keeps_changes_and_merges_them(spark, tmp_path):
    """Batches write changed keys only; every third one merges, and nothing older stays."""
    want = {}
    for i in range(8):
        (tmp_path / "in").mkdir(exist_ok=True)
        (tmp_path / f"in/{i}.csv").write_text(f"k{i % 3},{i}\n" + (f"k9,{i}\n" if i < 2 else ""))
        for k in [f"k{i % 3}", *(["k9"] if i < 2 else [])]:
            want[k] = (want.get(k, (0, 0))[0] + 1, i)
        rows = spark.readStream.schema("k string, v int").csv(f"{tmp_path}/in")
        summary = rows.groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.max("v").alias("v"))
        got = ingest.run_to_folder(summary, "k", f"{tmp_path}/o", f"{tmp_path}/c", merge_every=3)
        assert {r.k: (r.n, r.v) for r in got.collect()} == want
        kept = {p.name for p in (tmp_path / "o").iterdir()}
        assert kept == ({f"base={i // 3 * 3 - 1}"} if i > 2 and i % 3 != 2 else {f"base={i}"} if i % 3 == 2 else set()) | {
            f"batch={n}" for n in range(i // 3 * 3, i + 1) if i % 3 != 2}
    again = ingest.run_to_folder(summary, "k", f"{tmp_path}/o", f"{tmp_path}/c", merge_every=3)
    assert {r.k: (r.n, r.v) for r in again.collect()} == want


def test_run_summary_and_corpus_stats(spark):
    reviews = spark.createDataFrame([("a", 1), ("a", 0)], "k string, e int")
    meta = spark.createDataFrame([("a", "A", 9)], "k string, place_name string, n_reviews long")
    inputs = spark.createDataFrame([("a", 5), ("b", 6)], "k string, n_reviews int")
    got = {r.k: r for r in profile.run_summary(reviews, meta, inputs, "k", "e").collect()}
    assert (got["a"].n_scraped, got["a"].n_errors, got["a"].n_max, got["b"].n_scraped) == (2, 1, 9, 0)
    df = spark.createDataFrame([("h", "um. dois três"), ("h", ""), ("g", None)], "k string, t string")
    stats = profile.corpus_stats(df.withColumn("s", X.sentence_tokens("t", [], 1)), "k", "t", "s").head()
    assert tuple(stats) == (2, 1, 2, 3)


def test_cast_columns_keeps_rows(spark):
    df = spark.createDataFrame([("2024-01-01",), ("bad",)], "d string")
    assert [r.d for r in cast_columns(df, {"d": "timestamp_ntz"}).collect()] == [datetime(2024, 1, 1), None]


def test_review_text_ends_where_the_page_ends_it(spark):
    cases = {
        '<span class="review-full-text">Bom <b>e <b>caro</b></b> hotel</span> fora': "Bom e caro hotel",
        '<div class="a review-full-text b">Um<br>dois<img src="x"/>tres<span class="k8MTF">Quartos: 5</span>quatro</div>': "Um dois tres",
        '<div><span data-expandable-section="1">Curto <i>texto</i></span></div>': "Curto texto",
        '<span class="review-full-text">longo</span><span data-expandable-section>curto</span>': "longo",
        '<span class="review-full-text"><span class="x">nada</span></span>': "",
        "<p>sem texto</p>": None,
        None: None,
    }
    df = spark.createDataFrame([(h, t) for h, t in cases.items()], "html string, want string")
    got = [(r.want, r.got) for r in df.select("want", pages.review_text("html").alias("got")).collect()]
    assert all(a == b for a, b in got), got


def test_contexts_say_what_is_not_known(spark):
    columns = ("nome", "estrelas", "regiao", "estado", "cidade", "subcategoria", "classificacao_geral", "quantidade_avaliacoes",
               "nota_avaliacao", "curtidas_avaliacao", "usuario_guia_local", "nota_quartos", "nota_localizacao", "nota_servico", "text")
    kinds = {c: "string" if c in ("nome", "regiao", "estado", "cidade", "subcategoria", "text") else "double" for c in columns}
    df = spark.createDataFrame([tuple([None] * len(columns))], ", ".join(f"{c} {k}" for c, k in kinds.items())).withColumn("rank", F.lit(1))
    text = df.select(retrieval.render_review("rank").alias("t")).head().t
    assert text.count("não informado") == 11 and text.startswith(" - Avaliação 1")
    row = retrieval.hotel_context(df.withColumn("k", F.lit(1)), ["k"]).head()
    assert row.n_blocks == 1 and "Top 1" in row.context
    assert spark.range(1).select(retrieval.fill("a {x} b", {"x": F.lit(None).cast("string")})).head()[0] == "a não informado b"
