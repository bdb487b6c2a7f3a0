"""Field extraction from page text, HTML and embedded JSON with column expressions."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rentlens.functions.numeric import as_col
from rentlens.functions.text import capture, local_amount, status_word, strip_accents_lower, distance_metres, to_integer, to_number, yes_no

# fixed values: patterns of the listing site's page text (rooms and baths are case-sensitive on purpose:
# lower-case forms belong to badges and to other listings on the same page)
DETAIL_PATTERNS: dict[str, str] = {
    "fecha_publicacion_texto": r"(?i)Publicado (hoy|esta semana|hace [^\n|]+)",
    "superficie_total_m2": r"(?i)Superficie total\s*([\d.,]+)\s*m",
    "superficie_util_m2": r"(?iu)Superficie útil\s*([\d.,]+)\s*m",
    "dormitorios": r"Dormitorios\s*(\d+)",
    "banos": r"Baños\s*(\d+)",
    "estacionamientos": r"(?i)Estacionamientos:?\s*(\d+)",
    "antiguedad_anos": r"(?iu)Antigüedad\s*(\d+)\s*años?",
    "amoblado": r"(?iu)Amoblado:?\s*(Sí|No)",
    "admite_mascotas": r"(?iu)Admite mascotas:?\s*(Sí|No)",
    "condominio_cerrado": r"(?iu)En condominio cerrado:?\s*(Sí|No)",
    "bodegas": r"(?i)Bodegas\s*(\d+)",
    "gastos_comunes": r"(?i)Gastos comunes:?\s*\$?\s*([\d.,]+)",
    "estacionamiento_visitas": r"(?iu)Estacionamiento de visitas:?\s*(Sí|No)",
    "solo_familias": r"(?iu)Solo familias:?\s*(Sí|No)",
    "max_habitantes": r"(?iu)Cantidad máxima de habitantes\s*(\d+)",
    "piscina": r"(?iu)Piscina:?\s*(Sí|No)",
    "quincho": r"(?iu)Quincho\D{0,15}?:?\s*(Sí|No)",
    "conserjeria": r"(?iu)Conserjería:?\s*(Sí|No)",
    "ascensor": r"(?iu)Ascensor:?\s*(Sí|No)",
    "piso_unidad": r"(?iu)Número de piso de la unidad\s*(\d+)",
    "deptos_por_piso": r"(?i)Departamentos por piso\s*(\d+)",
}
# fixed values: second pattern tried when the first finds nothing
FALLBACK_PATTERNS = {"gastos_comunes": r"(?i)Gastos comunes\s+desde\s*\$?\s*([\d.,]+)"}
# fixed values: cast of each extracted field
BOOLEAN_FIELDS = [
    "amoblado", "admite_mascotas", "condominio_cerrado", "estacionamiento_visitas", "solo_familias", "piscina", "quincho",
    "conserjeria", "ascensor",
]
INTEGER_FIELDS = ["dormitorios", "banos", "estacionamientos", "antiguedad_anos", "bodegas", "max_habitantes", "piso_unidad", "deptos_por_piso"]
REAL_FIELDS = ["superficie_total_m2", "superficie_util_m2", "latitud", "longitud"]
AMOUNT_FIELDS = ["gastos_comunes"]
# fixed values: subcategory titles (accents removed) and their column keys
POI_KEYS = {
    "paraderos": "paraderos", "estaciones de metro": "estaciones_metro", "jardines infantiles": "jardines_infantiles",
    "colegios": "colegios", "universidades": "universidades", "plazas": "plazas", "supermercados": "supermercados",
    "farmacias": "farmacias", "centros comerciales": "centros_comerciales", "hospitales": "hospitales", "clinicas": "clinicas",
}
# fixed values: result-card markup and attributes
CARD_CONTAINERS = [("div", "ui-search-result__wrapper"), ("div", "andes-card"), ("li", "ui-search-layout__item")]
CARD_ROOMS = r"(?i)(\d+)\s*dormitorios?"
CARD_BATHS = r"(?iu)(\d+)\s*ba[ñn]os?"
CARD_AREA = r"(?i)([\d.,]+)\s*m[²2](?![a-zA-Z0-9_])"
STATE_JSON = r"(?s)_n\.ctx\.r=(\{.*?\});_n\.ctx\.r\.assets\.manifest="
LATITUDE, LONGITUDE = r'"latitude":"(-?[\d.]+)"', r'"longitude":"(-?[\d.]+)"'
MAP_CENTRE = r"center=(-?[\d.]+)%2C(-?[\d.]+)"
STATUS_IDS = ["item_status_message", "item_status_short_description_message"]


def visible_text(html: Column | str, separator: str = "\n") -> Column:
    """Page text: scripts, styles and tags removed, one line per block."""
    no_code = F.regexp_replace(as_col(html), r"(?is)<(script|style)\b.*?</\1>", " ")
    return F.trim(F.regexp_replace(F.regexp_replace(no_code, r"(?s)<[^>]+>", separator), r"\s*\n\s*", separator))


def extract_attributes(
    df: DataFrame, text: str, patterns: Mapping[str, str] = DETAIL_PATTERNS, fallbacks: Mapping[str, str] = FALLBACK_PATTERNS
) -> DataFrame:
    """Adds one text column per (name, pattern); a fallback pattern is used where the first finds nothing."""
    fields = {}
    for name, pattern in patterns.items():
        value = capture(text, pattern)
        if name in fallbacks:
            value = F.coalesce(value, capture(text, fallbacks[name]))
        if name == "fecha_publicacion_texto":
            value = F.regexp_replace(value, r"(?i)^hace ", "")
        fields[name] = F.trim(value)
    return df.withColumns(fields)


def convert_typed(
    df: DataFrame, booleans: Sequence[str] = BOOLEAN_FIELDS, integers: Sequence[str] = INTEGER_FIELDS,
    reals: Sequence[str] = REAL_FIELDS, amounts: Sequence[str] = AMOUNT_FIELDS,
) -> DataFrame:
    """Cast extracted texts by field list; absent columns are skipped, unreadable values become null."""
    casts = {
        **{c: yes_no(c).cast("int") for c in booleans}, **{c: to_integer(c) for c in integers},
        **{c: to_number(c) for c in reals}, **{c: local_amount(c) for c in amounts},
    }
    return df.withColumns({c: e for c, e in casts.items() if c in df.columns})


def once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)``, where the value is computed once however often ``use`` names it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def price_widget(card: Column | str) -> Column:
    """The card's current price widget: the marked one, else the first not struck through, else the first."""
    widgets = F.regexp_extract_all(as_col(card), F.lit(r'(?s)(<(?:span|s|div)\s+class="[^"]*andes-money-amount[ "].*?(?=<(?:span|s|div)\s+class="[^"]*andes-money-amount[ "]|$))'), F.lit(1))

    def best(found: Column) -> Column:
        current = F.filter(found, lambda w: w.rlike(r'^<\w+\s+class="[^"]*poly-price__amount'))
        live = F.filter(found, lambda w: ~w.rlike(r'^<\w+\s+class="[^"]*andes-money-amount--previous'))
        return F.coalesce(F.get(current, F.lit(0)), F.get(live, F.lit(0)), F.get(found, F.lit(0)))

    return once(widgets, best)


def current_price_pair(card: Column | str) -> Column:
    """struct(precio, moneda), both read from the same widget, so they never mix two prices."""
    return once(price_widget(card), lambda w: F.struct(
        F.trim(capture(w, r'andes-money-amount__fraction[^>]*>([^<]+)<')).alias("precio"),
        F.trim(capture(w, r'andes-money-amount__currency-symbol[^>]*>([^<]+)<')).alias("moneda"),
    ))


def opening_tag(tag: str, css_class: str) -> str:
    """Pattern of an opening tag that has the class among its classes, wherever the attribute stands."""
    return rf"""(?i)<{tag}\b[^>]*?\bclass\s*=\s*["'](?:[^"']*\s)?{css_class}(?:\s[^"']*)?["'][^>]*>"""


def split_cards(df: DataFrame, html: str, markers: Sequence[str] | None = None, out: str = "card") -> DataFrame:
    """One row per result card of a page, with its position; pages without a card give none.

    Of the markers, each page is split at the first that it holds.
    """
    parts = [F.split(F.col(html), m) for m in markers or [opening_tag(*c) for c in CARD_CONTAINERS]]
    split = F.coalesce(*[once(p, lambda found: F.when(F.size(found) > 1, F.slice(found, F.lit(2), F.size(found)))) for p in parts])
    pieces = F.coalesce(split, F.array().cast("array<string>"))
    return df.select(*[c for c in df.columns if c != html], F.posexplode(pieces).alias("pos", out))


def extract_cards(df: DataFrame, html: str, markers: Sequence[str] | None = None) -> DataFrame:
    """One listing per card: title, price and currency, place, url, id and attributes."""
    cards = split_cards(df, html, markers)
    text = visible_text("card", " ")
    link = F.coalesce(
        capture("card", r'(?s)class="[^"]*(?:ui-search-link|poly-component__title)[^"]*"[^>]*?href="([^"]+)"'),
        capture("card", r'(?s)href="([^"]+)"[^>]*?class="[^"]*(?:ui-search-link|poly-component__title)'),
    )
    return (
        cards.withColumn("_text", text)
        .withColumn("_price", current_price_pair("card"))
        .withColumns(
            {
                "titulo": F.trim(capture("card", r'class="[^"]*(?:ui-search-item__title|poly-component__title)[^"]*"[^>]*>(?:<a[^>]*>)?([^<]+)<')),
                "precio": F.col("_price.precio"), "moneda": F.col("_price.moneda"),
                "ubicacion": F.trim(capture("card", r'class="[^"]*(?:ui-search-item__location|poly-component__location)[^"]*"[^>]*>([^<]+)<')),
                "url": link, "id_aviso": capture(link, r"(MLC-\d+)"),
                "dormitorios": capture("_text", CARD_ROOMS), "banos": capture("_text", CARD_BATHS), "superficie_m2": capture("_text", CARD_AREA),
            }
        )
        .drop("_text", "_price", "card")
    )


def extract_state_json(html: Column | str, pattern: str = STATE_JSON) -> Column:
    """The JSON text embedded between two markers; null when absent or not valid JSON."""
    raw = capture(html, pattern)
    return F.when(F.try_parse_json(raw).isNotNull(), raw)


def find_first_value(json: Column | str, key: str) -> Column:
    """First non-empty string stored under ``key`` anywhere in the JSON text, with its escapes decoded.

    Every string of the text is one match, so the key's name inside another string does not count. Escaped backslashes
    and quotes stand aside for the search as control characters, which no JSON string may hold.
    """
    escapes = ((r"\\", "\x01"), (r"\"", "\x02"))
    plain = as_col(json)
    for text, mark in escapes:
        plain = F.replace(plain, F.lit(text), F.lit(mark))
    strings = F.regexp_extract_all(plain, F.lit(rf'"\Q{key}\E"\s*:\s*"([^"]+)"|"[^"]*"'), F.lit(1))
    raw = F.get(F.filter(strings, lambda x: x != ""), F.lit(0))
    for text, mark in escapes:
        raw = F.replace(raw, F.lit(mark), F.lit(text))
    return F.coalesce(F.get_json_object(F.concat(F.lit('{"v":"'), raw, F.lit('"}')), "$.v"), raw)


CATEGORY_SCHEMA = (
    "array<struct<subcategories: array<struct<title: struct<text: string>, "
    "items: array<struct<subtitle: struct<label: struct<text: string>>>>>>>>"
)


def find_categories(df: DataFrame, json: str, id_col: str) -> DataFrame:
    """id, categoria, distancia_m for each item of each known subcategory (distance null for an empty one).

    Every text after a ``"categories":`` is parsed as JSON; the first array with an object that has
    ``subcategories`` counts, whatever its other fields hold.
    """
    marker = r'"categories"\s*:\s*(?=\[)'
    pieces = F.split(F.col(json), marker)
    tails = F.transform(F.sequence(F.lit(2), F.size(pieces)), lambda i: F.array_join(F.slice(pieces, i, F.size(pieces)), '"categories":'))
    lists = F.transform(tails, lambda tail: F.from_json(tail, CATEGORY_SCHEMA))
    wanted = F.filter(lists, lambda one: F.exists(one, lambda c: c["subcategories"].isNotNull()))
    found = df.filter(F.size(F.split(F.col(json), marker)) > 1).select(id_col, F.get(wanted, F.lit(0)).alias("_list"))
    cats = found.select(id_col, F.explode("_list").alias("c"))
    subs = cats.select(id_col, F.explode("c.subcategories").alias("s"))
    keys = F.create_map(*[F.lit(x) for kv in POI_KEYS.items() for x in kv])
    named = subs.withColumn("categoria", F.try_element_at(keys, strip_accents_lower("s.title.text"))).filter("categoria IS NOT NULL")
    return named.select(id_col, "categoria", F.explode_outer("s.items").alias("i")).select(
        id_col, "categoria", distance_metres("i.subtitle.label.text").alias("distancia_m")
    )


def extract_status_text(json: Column | str, ids: Sequence[str] = STATUS_IDS) -> Column:
    """Text of the status component under the page's head, else under its short description.

    '' when the component has no text, null when there is no such component.
    """
    pattern = r'(?s)"id"\s*:\s*"(?:' + "|".join(ids) + r')"(.*?)(?="id"\s*:|$)'
    found = []
    for part in ("head", "short_description"):
        subtree = F.get_json_object(as_col(json), f"$.appProps.pageProps.initialState.components.{part}")
        piece = F.regexp_extract(subtree, pattern, 0)
        text = F.regexp_extract(piece, r'"body"\s*:\s*\{[^{}]*?"text"\s*:\s*"((?:[^"\\]|\\.)*)"', 1)
        found.append(F.when(piece != "", text))
    return F.coalesce(*found)


def publication_status(json: Column | str) -> Column:
    return status_word(extract_status_text(json))


def extract_coordinates(html: Column | str) -> Column:
    """struct(latitud, longitud) as text: both from the page data, else both from the map link."""
    lat, lon = capture(html, LATITUDE), capture(html, LONGITUDE)
    both = lat.isNotNull() & lon.isNotNull()
    return F.struct(
        F.when(both, lat).otherwise(capture(html, MAP_CENTRE, 1)).alias("latitud"),
        F.when(both, lon).otherwise(capture(html, MAP_CENTRE, 2)).alias("longitud"),
    )


# fixed values: description containers in order of preference
DESCRIPTION_PATTERNS = [
    r"(?s)data-testid=['\"]core-description['\"][^>]*>.*?<p[^>]*>(.*?)</p>",
    r"(?s)<p[^>]*class=['\"][^'\"]*ui-pdp-description__content[^'\"]*['\"][^>]*>(.*?)</p>",
    r"(?s)<div[^>]*class=['\"][^'\"]*ui-pdp-description['\" ][^>]*>(.*?)</div>",
]


def extract_description(html: Column | str, patterns: Sequence[str] = DESCRIPTION_PATTERNS) -> Column:
    """Text of the first container that is present."""
    return F.coalesce(*[F.trim(F.regexp_replace(capture(html, p), r"<[^>]+>", "")) for p in patterns])


def canonical_link(html: Column | str) -> Column:
    return F.coalesce(
        capture(html, r'<link[^>]*rel="canonical"[^>]*href="([^"]*)"'), capture(html, r'<link[^>]*href="([^"]*)"[^>]*rel="canonical"')
    )


def og_url(html: Column | str) -> Column:
    return F.coalesce(
        capture(html, r'<meta[^>]*property="og:url"[^>]*content="([^"]*)"'), capture(html, r'<meta[^>]*content="([^"]*)"[^>]*property="og:url"')
    )
