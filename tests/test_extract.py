from pyspark.sql import functions as F

from rentlens.operators import extract as X
from rentlens.operators import quality

CARD = (
    '<ol><li class="ui-search-layout__item"><h3 class="poly-component__title"><a class="poly-component__title" href="https://s/MLC-123-depto">Depto lindo</a></h3>'
    '<s class="andes-money-amount andes-money-amount--previous"><span class="andes-money-amount__currency-symbol">UF</span><span class="andes-money-amount__fraction">15</span></s>'
    '<div class="poly-price__current"><span class="andes-money-amount poly-price__amount"><span class="andes-money-amount__currency-symbol">$</span>'
    '<span class="andes-money-amount__fraction">450.000</span></span></div><ul><li>3 dormitorios</li><li>2 baños</li><li>84 m² útiles</li></ul>'
    '<span class="poly-component__location">Centro, Concepción</span></li><li class="ui-search-layout__item"><p>vacía</p></li></ol>'
)
TEXT = (
    "2 baños\n75 m² totales\nPublicado hace 11 días\nGastos comunes desde $ 82.000\nSuperficie total\n75 m²\nSuperficie útil 70,5 m²\nDormitorios\n3\nBaños\n2\n"
    "Piscina: Sí\nNúmero de piso de la unidad 8\nAntigüedad 5 años\n3 dormitorios"
)


def test_cards(spark):
    rows = X.extract_cards(spark.createDataFrame([(1, CARD), (2, "<p>nada</p>")], "page int, html string"), "html").orderBy("pos").collect()
    assert len(rows) == 2
    r = rows[0]
    assert (r["precio"], r["moneda"], r["id_aviso"], r["titulo"]) == ("450.000", "$", "MLC-123", "Depto lindo")
    assert (r["dormitorios"], r["banos"], r["superficie_m2"], r["ubicacion"]) == ("3", "2", "84", "Centro, Concepción")
    assert rows[1]["precio"] is None


def test_price_without_marked_widget(spark):
    old = '<span class="andes-money-amount andes-money-amount--previous"><span class="andes-money-amount__fraction">9</span></span>'
    live = '<span class="andes-money-amount"><span class="andes-money-amount__currency-symbol">UF</span><span class="andes-money-amount__fraction">7</span></span>'
    got = [spark.range(1).select(X.current_price_pair(F.lit(h)).alias("p")).first()["p"] for h in (old + live, old, "x")]
    assert [tuple(g) for g in got] == [("7", "UF"), ("9", None), (None, None)]


def test_detail_fields(spark):
    out = X.convert_typed(X.extract_attributes(spark.createDataFrame([(TEXT,)], "t string"), "t")).first()
    assert (out["banos"], out["dormitorios"], out["piscina"], out["piso_unidad"], out["antiguedad_anos"]) == (2, 3, 1, 8, 5)
    assert (out["gastos_comunes"], out["superficie_total_m2"], out["fecha_publicacion_texto"], out["quincho"]) == (82000.0, 75.0, "11 días", None)


def test_state_json(spark):
    body = '{"a":{"neighborhood":"","b":[{"neighborhood":"Lomas"}]},"categories":[{"id":"x","subcategories":[{"title":{"text":"Paraderos"},"items":[{"subtitle":{"label":{"text":"1 mins - 80 metros"}}},{"subtitle":{"label":{"text":"9 mins - 1.2 km"}}}]},{"title":{"text":"Clínicas"},"items":[]},{"title":{"text":"Otra"},"items":[]}]}]}'
    page = f"<script>window._n.ctx.r={body};_n.ctx.r.assets.manifest=1</script>"
    df = spark.createDataFrame([(1, page), (2, "<p>"), (3, page.replace('"a":', "a:"))], "id int, html string").withColumn("j", X.extract_state_json("html"))
    assert [r["j"] is not None for r in df.orderBy("id").collect()] == [True, False, False]
    assert df.filter("id = 1").select(X.find_first_value("j", "neighborhood")).first()[0] == "Lomas"
    items = X.find_categories(df, "j", "id")
    got = quality.poi_counts(items, "id", "categoria", "distancia_m", ["paraderos", "clinicas", "plazas"]).first()
    assert tuple(got) == (1, 1, 80.0, 0, None, None, None)


def test_status(spark):
    def state(head, short):
        return '{"appProps":{"pageProps":{"initialState":{"components":{"head":[%s],"short_description":[%s]}}}}}' % (head, short)

    msg = '{"id":"item_status_message","body":{"text":"%s"}}'
    cases = {state("", ""): "activo", state(msg % "Publicación pausada", ""): "pausado", state("", msg % "Finalizada"): "finalizado", state(msg % "raro", ""): "pausado",
             state('{"id":"item_status_message"}', ""): "pausado", '{"components":[%s]}' % (msg % "pausada"): "activo"}
    for json, want in cases.items():
        assert spark.range(1).select(X.publication_status(F.lit(json))).first()[0] == want


def test_coordinates_description_links(spark):
    one = lambda c: spark.range(1).select(c.alias("x")).first()["x"]
    assert tuple(one(X.extract_coordinates(F.lit('"latitude":"-36.8","longitude":"-73.0"')))) == ("-36.8", "-73.0")
    assert tuple(one(X.extract_coordinates(F.lit('"latitude":"-36.8" center=-1.5%2C-2.5')))) == ("-1.5", "-2.5")
    assert one(X.extract_description(F.lit('<p class="ui-pdp-description__content"> Hola <b>mundo</b></p>'))) == "Hola mundo"
    assert one(X.canonical_link(F.lit('<link href="u/MLC-1" rel="canonical">'))) == "u/MLC-1"
    assert one(X.og_url(F.lit('<meta property="og:url" content="u">'))) == "u"


def test_first_value_of_a_key(spark):
    import json

    states = [
        ({"a": [{"k": ""}, {"k": None}, {"k": 3}], "b": {"c": [[{"k": 'Villa "El Roble" \\ 2/3\n'}]]}}, 'Villa "El Roble" \\ 2/3\n'),
        ({"t": 'text with "k":"no" inside', "u": '\\"k":"no', "k": "yes"}, "yes"),
        ({"t": "k", "xk": "no", "kx": "no", "k": "ñandú"}, "ñandú"),
        ({"t": "ends with \\", "k": 'x"'}, 'x"'),
        ({"t": ["k", "x"]}, None),
        ({"k": "a" * 100_000 + '"' * 20_000}, "a" * 100_000 + '"' * 20_000),
    ]
    rows = [(i, json.dumps(s, ensure_ascii=bool(i % 2))) for i, (s, _) in enumerate(states)] + [(90, None), (91, ""), (92, '{"k" : "spaced"}'), (93, '{"k":"cut')]
    df = spark.createDataFrame(rows, "id int, j string")
    got = {r[0]: r[1] for r in df.select("id", X.find_first_value("j", "k")).collect()}
    assert got == {i: want for i, (_, want) in enumerate(states)} | {90: None, 91: None, 92: "spaced", 93: None}


def test_cards_of_a_small_file_are_read_by_all_tasks(spark):
    """The parts come as one task's rows; each page's price pattern runs once."""
    from __spark_entry__ import queries
    from rentlens.session import parallelism

    cards = queries()["extract_cards"](spark, "/root/testdata/sf0.001")
    assert cards.rdd.getNumPartitions() >= parallelism(spark)
    plan = cards._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract_all") == 1
