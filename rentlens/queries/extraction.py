"""Text, HTML and JSON extraction over the pages and events tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from rentlens.functions import text as T
from rentlens.operators import extract as X
from rentlens.queries.registry import query, rounded
from rentlens.session import dealt

PAGE_PATTERNS = {
    "titulo": r"<title>([^<]+)</title>",
    "encabezado": r"<h1>([^<]+)</h1>",
    "idioma": r'<html lang="([a-z]+)"',
    "pista": r"track\((\d+)\)",
    "anuncio": r"<!-- ad (\d+) -->",
}


@query("extract_attributes", """SELECT page_id, nullif(trim(regexp_extract(html,'<title>([^<]+)</title>',1)),'') AS titulo, nullif(trim(regexp_extract(html,'<h1>([^<]+)</h1>',1)),'') AS encabezado, nullif(regexp_extract(html,'<html lang="([a-z]+)"',1),'') AS idioma,
 nullif(regexp_extract(html,'track\\((\\d+)\\)',1),'') AS pista, coalesce(nullif(regexp_extract(html,'<!-- ad (\\d+) -->',1),''), nullif(regexp_extract(html,'class="ad">([A-Za-z]+)',1),'')) AS anuncio FROM pages""".replace("\\\\", "\\"))
def _(t):
    out = X.extract_attributes(t.pages, "html", PAGE_PATTERNS, {"anuncio": r'class="ad">([A-Za-z]+)'})
    return out.select("page_id", *PAGE_PATTERNS)


@query("extract_cards", """SELECT p_partkey AS id, p::BIGINT AS pos, p_name||' '||p AS titulo, CASE WHEN p=1 THEN p_size||'.000' ELSE p_size||'' END AS precio, CASE WHEN p=1 THEN '$' ELSE 'UF' END AS moneda, p_type AS ubicacion,
 'https://example.org/MLC-'||(p_partkey*10+p)||'-x' AS url, 'MLC-'||(p_partkey*10+p) AS id_aviso, (p_size%5)||'' AS dormitorios, (p_size%3)||'' AS banos, p_size||'' AS superficie_m2 FROM part, (VALUES (0),(1)) v(p) WHERE p_partkey % 4 < 3""")
def _(t):
    """Result pages built from the parts table: two cards a page, in one of the three containers, with several classes and attributes."""
    opening = F.expr("""CASE p_partkey % 4 WHEN 0 THEN '<div id="c" class="x ui-search-result__wrapper y">' WHEN 1 THEN '<div class="andes-card andes-card--flat">'
        WHEN 2 THEN '<li data-n="1" class="ui-search-layout__item shops">' ELSE '<p class="andes-card__header">' END""")

    def card(p: int):
        key = (F.col("p_partkey") * 10 + p).cast("string")
        return F.concat(
            opening, F.lit('<a class="poly-component__title" href="https://example.org/MLC-'), key, F.lit('-x">'), F.col("p_name"), F.lit(f" {p}</a>"),
            F.lit('<span class="andes-money-amount"><span class="andes-money-amount__currency-symbol">' + ("UF", "$")[p] + '</span><span class="andes-money-amount__fraction">'),
            F.col("p_size").cast("string"), F.lit(("", ".000")[p] + '</span></span><span class="poly-component__location">'), F.col("p_type"), F.lit("</span><i>"),
            (F.col("p_size") % 5).cast("string"), F.lit(" dormitorios</i><i>"), (F.col("p_size") % 3).cast("string"), F.lit(" baños</i><i>"), F.col("p_size").cast("string"), F.lit(" m² totales</i>"),
        )

    # the parts are narrow and may come as one task's rows; a page's patterns are much more work than its part's bytes
    parts = t.part.select("p_partkey", "p_name", "p_size", "p_type")
    pages = dealt(parts, parts.count(), "p_partkey").select(F.col("p_partkey").alias("id"), F.concat(F.lit("<html>"), card(0), card(1)).alias("html"))
    return X.extract_cards(pages, "html").withColumn("pos", F.col("pos").cast("long"))


@query("split_cards", """WITH c AS (SELECT page_id, unnest(string_split(html,'<li>')[2:]) AS card FROM pages) SELECT page_id, nullif(regexp_extract(card,'href="/([^"]*)"',1),'') AS url, count(*) AS n FROM c GROUP BY 1,2""")
def _(t):
    cards = X.split_cards(t.pages.select("page_id", "html"), "html", ["<li>"])
    return cards.groupBy("page_id", T.capture("card", r'href="/([^"]*)"').alias("url")).agg(F.count(F.lit(1)).alias("n"))


@query("current_price_pair", """SELECT p_partkey AS id, CAST(p_size AS VARCHAR)||'.000' AS precio, CASE WHEN p_partkey % 2 = 0 THEN 'UF' ELSE '$' END AS moneda FROM part""")
def _(t):
    """Cards built from the parts table: a struck-through old price in another currency stands before the current one."""
    card = F.concat(
        F.lit('<s class="andes-money-amount andes-money-amount--previous"><span class="andes-money-amount__currency-symbol">US$</span><span class="andes-money-amount__fraction">99</span></s>'
              '<span class="andes-money-amount poly-price__amount"><span class="andes-money-amount__currency-symbol">'),
        F.when(F.col("p_partkey") % 2 == 0, "UF").otherwise("$"),
        F.lit('</span><span class="andes-money-amount__fraction">'), F.col("p_size").cast("string"), F.lit(".000</span></span>"),
    )
    return t.part.select(F.col("p_partkey").alias("id"), X.current_price_pair(card).alias("p")).select("id", "p.precio", "p.moneda")


@query("find_first_value", """SELECT event_id, json_extract_string(props,'$.k') AS k FROM events""")
def _(t):
    nested = F.concat(F.lit('{"a":[{"k":""}],"b":{"k":"'), F.get_json_object("props", "$.k"), F.lit('"}}'))
    return t.events.select("event_id", X.find_first_value(nested, "k").alias("k"))


@query("extract_state_json", """SELECT event_id, CASE WHEN event_type='error' THEN NULL WHEN event_type='signup' THEN NULL ELSE props END AS estado FROM events""")
def _(t):
    """Pages built from the event payloads: errors lack the block, sign-ups hold a broken one."""
    body = F.when(F.col("event_type") == "signup", F.concat(F.lit("{"), F.col("props"))).otherwise(F.col("props"))
    page = F.when(F.col("event_type") == "error", F.lit("<html></html>")).otherwise(
        F.concat(F.lit("<script>_n.ctx.r="), body, F.lit(";_n.ctx.r.assets.manifest=1</script>"))
    )
    return t.events.select("event_id", X.extract_state_json(page).alias("estado"))


@query("find_categories", """SELECT event_id AS id, CASE event_type WHEN 'click' THEN 'clinicas' WHEN 'view' THEN 'jardines_infantiles' ELSE 'plazas' END AS categoria, round(value,6) AS distancia_m FROM events WHERE event_type IN ('click','view','purchase')""")
def _(t):
    """Page state built from events: one known subcategory with one item, next to an unknown one."""
    title = F.expr("CASE event_type WHEN 'click' THEN 'Clínicas' WHEN 'view' THEN 'Jardines Infantiles' WHEN 'purchase' THEN 'Plazas' ELSE 'Otros' END")
    state = F.concat(
        F.lit('{"x":{"categories":[1]},"y":[{"categories":[{"icon":{"name":"[1]","sizes":[1,2]},"title":"a [b] {c}","subcategories":[{"title":{"text":"Nada"},"items":[]},{"title":{"text":"'), title,
        F.lit('"},"items":[{"subtitle":{"label":{"text":"1 mins - '), F.replace(F.col("value").cast("string"), F.lit("."), F.lit(",")),
        F.lit(' metros"}}}]}]}],"z":1}]}'),
    )
    out = X.find_categories(t.events.select(F.col("event_id").alias("id"), state.alias("estado")), "estado", "id")
    return rounded(out, "distancia_m")


@query("extract_status_text", """SELECT event_id, CASE event_type WHEN 'click' THEN 'pausado' WHEN 'view' THEN 'finalizado' WHEN 'purchase' THEN 'pausado' ELSE 'activo' END AS estado FROM events""")
def _(t):
    message = F.expr("CASE event_type WHEN 'click' THEN 'Publicación pausada' WHEN 'view' THEN 'Publicación finalizada' ELSE 'Otro' END")
    part = F.concat(F.lit('{"id":"item_status_message","type":"m","body":{"text":"'), message, F.lit('"}}'))
    holder = F.when(F.col("event_type").isin("click", "view", "purchase"), part).otherwise(F.lit('{"id":"otro","body":{"text":"finaliza"}}'))
    state = F.concat(F.lit('{"appProps":{"pageProps":{"initialState":{"components":{"head":[{"id":"titulo","body":{"text":"x"}}],"short_description":['), holder, F.lit("]}}}}}"))
    return t.events.select("event_id", X.publication_status(state).alias("estado"))


@query("extract_coordinates", """SELECT p_partkey AS id, CASE WHEN p_partkey % 3 = 2 THEN NULL ELSE CAST(-p_size AS VARCHAR)||'.5' END AS latitud, CASE WHEN p_partkey % 3 = 2 THEN NULL ELSE CAST(-p_size-30 AS VARCHAR)||'.25' END AS longitud FROM part""")
def _(t):
    la, lo = F.concat((-F.col("p_size")).cast("string"), F.lit(".5")), F.concat((-F.col("p_size") - 30).cast("string"), F.lit(".25"))
    page = F.when(F.col("p_partkey") % 3 == 0, F.concat(F.lit('{"latitude":"'), la, F.lit('","longitude":"'), lo, F.lit('"}'))).when(
        F.col("p_partkey") % 3 == 1, F.concat(F.lit("maps?center="), la, F.lit("%2C"), lo, F.lit("&zoom=1"))
    ).otherwise(F.lit("nada"))
    return t.part.select(F.col("p_partkey").alias("id"), X.extract_coordinates(page).alias("c")).select("id", "c.latitud", "c.longitud")


@query("extract_description", """SELECT page_id, nullif(regexp_extract(html,'<div class="ad">([^<]*)</div>',1),'') AS descripcion FROM pages""")
def _(t):
    return t.pages.select("page_id", X.extract_description("html", [r'<p class="none">([^<]*)</p>', r'<div class="ad">([^<]*)</div>']).alias("descripcion"))


@query("convert_typed", """SELECT id, try_cast(trim(numero_txt) AS DOUBLE) AS latitud, trunc(try_cast(trim(numero_txt) AS DOUBLE))::INT AS dormitorios, CASE WHEN lower(trim(condominio_txt)) IN ('sí','si','true','1','1.0') THEN 1 WHEN lower(trim(condominio_txt)) IN ('no','false','0','0.0') THEN 0 END AS piscina FROM raw_listings""", ["raw_listings"])
def _(t):
    src = t.raw_listings.select("id", F.col("numero_txt").alias("latitud"), F.col("numero_txt").alias("dormitorios"), F.col("condominio_txt").alias("piscina"))
    return X.convert_typed(src)


@query("match_check", """SELECT page_id, contains(url,'-') AND contains(html,'<h1>') AND page_id % 2 = 0 AS coincide FROM pages""")
def _(t):
    """Head tags built around the page: the canonical link is right when the page has a heading and its url a dash."""
    ok = F.contains(F.col("url"), F.lit("-")) & F.contains(F.col("html"), F.lit("<h1>"))
    tags = F.concat(
        F.lit('<link rel="canonical" href="https://x/'), F.when(ok, F.concat(F.lit("MLC-"), F.col("page_id").cast("string"))).otherwise(F.lit("lista")),
        F.lit('"><meta property="og:url" content="https://x/'), F.when(F.col("page_id") % 2 == 0, F.concat(F.lit("MLC-"), F.col("page_id").cast("string"))).otherwise(F.lit("?")), F.lit('">'), F.col("html"),
    )
    listing = F.concat(F.lit("MLC-"), F.col("page_id").cast("string"))
    return t.pages.select("page_id", T.match_check(X.canonical_link(tags), X.og_url(tags), listing).alias("coincide"))


@query("block_check", """SELECT page_id, contains(substr(lower(html),1,8000),'footer') AND NOT regexp_matches(html,'Dormitorios\\s*\\d+|<h1>The') AS bloqueo FROM pages""".replace("\\\\", "\\"))
def _(t):
    return t.pages.select("page_id", T.block_check("html", "html", r"Dormitorios\s*\d+|<h1>The", word="footer").alias("bloqueo"))
