"""Saved connector payloads as documents: one parser a source, all column expressions over JSON or XML text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from topicloom.functions import text

COLUMNS = ("doc_id", "source", "native_id", "title", "abstract", "published_date", "year", "url", "venue", "authors", "institutions", "concepts", "citation_count", "scan_frame_key", "tone")
#: Whether a source reports each of its lists; the others are empty.
_EMPTY = "cast(array() as array<string>)"


def document(source: str, native_id: Column, title: Column, abstract: Column | None = None, date: Column | None = None, url: Column | None = None, venue: Column | None = None, authors: Column | None = None, institutions: Column | None = None, concepts: Column | None = None, citations: Column | None = None, tone: Column | None = None) -> list[Column]:
    """The normalised columns of a document."""
    blank = lambda c: F.trim(F.coalesce(c, F.lit(""))) if c is not None else F.lit("")
    names = lambda c: F.coalesce(c, F.expr(_EMPTY)) if c is not None else F.expr(_EMPTY)
    date = date if date is not None else F.lit(None).cast("date")
    return [
        text.document_id(F.lit(source), native_id).alias("doc_id"), F.lit(source).alias("source"), native_id.alias("native_id"), blank(title).alias("title"), blank(abstract).alias("abstract"),
        date.alias("published_date"), F.year(date).alias("year"), text.time_slice(date).alias("time_slice"), blank(url).alias("url"), blank(venue).alias("venue"),
        names(authors).alias("authors"), names(institutions).alias("institutions"), names(concepts).alias("concepts"),
        F.coalesce(citations, F.lit(0)).cast("int").alias("citation_count") if citations is not None else F.lit(0).alias("citation_count"), tone.cast("double").alias("tone") if tone is not None else F.lit(None).cast("double").alias("tone"),
    ]


def first_names(people: Column, field: str, limit: int = 20) -> Column:
    return F.slice(F.filter(F.transform(people, lambda p: p[field]), lambda x: x.isNotNull() & (x != "")), 1, limit)


def works(pages: DataFrame, body: str = "body") -> DataFrame:
    """Cursor-paged scholarly works: abstracts come as word -> positions."""
    schema = "results array<struct<id:string,title:string,publication_date:string,relevance_score:double,cited_by_count:int,abstract_inverted_index:map<string,array<int>>,primary_location:struct<landing_page_url:string,source:struct<display_name:string>>,authorships:array<struct<author:struct<display_name:string>,institutions:array<struct<display_name:string>>>>,concepts:array<struct<display_name:string>>>>"
    rows = pages.select("*", F.posexplode(F.from_json(body, schema)["results"]).alias("pos", "w"))
    w = F.col("w")
    people = F.transform(w["authorships"], lambda a: a["author"])
    places = text.sorted_set(F.transform(w["authorships"], lambda a: F.transform(a["institutions"], lambda i: i["display_name"])))
    columns = document("works", w["id"], w["title"], text.rebuild_abstract(F.to_json(w["abstract_inverted_index"])), text.parse_date(w["publication_date"]), w["primary_location"]["landing_page_url"], w["primary_location"]["source"]["display_name"], first_names(people, "display_name"), places, first_names(w["concepts"], "display_name"), w["cited_by_count"])
    return rows.select(*pages.drop(body).columns, "pos", w["relevance_score"].alias("score"), *columns)


def articles(pages: DataFrame, body: str = "body", types: tuple[str, ...] = (), titles: tuple[str, ...] = ()) -> DataFrame:
    """Offset-paged publisher records; excluded types and titles go; abstracts carry markup."""
    schema = "message struct<items:array<struct<DOI:string,title:array<string>,abstract:string,type:string,score:double,`is-referenced-by-count`:int,URL:string,`container-title`:array<string>,author:array<struct<given:string,family:string>>,issued:struct<`date-parts`:array<array<int>>>>>>"
    rows = pages.select("*", F.posexplode(F.from_json(body, schema)["message"]["items"]).alias("pos", "w"))
    w = F.col("w")
    title = F.try_element_at(w["title"], F.lit(1))
    keep = ~F.lower(F.trim(F.coalesce(w["type"], F.lit("")))).isin(list(types) or [""]) & ~F.lower(F.trim(F.coalesce(title, F.lit("")))).isin(list(titles) or [" "])
    names = F.slice(F.transform(w["author"], lambda a: F.concat_ws(" ", a["given"], a["family"])), 1, 20)
    columns = document("articles", w["DOI"], title, text.strip_markup(w["abstract"]), text.date_from_parts(F.try_element_at(w["issued"]["date-parts"], F.lit(1))), w["URL"], F.try_element_at(w["container-title"], F.lit(1)), names, citations=w["is-referenced-by-count"])
    return rows.where(keep).select(*pages.drop(body).columns, "pos", w["score"].alias("score"), *columns)


def preprints(feeds: DataFrame, body: str = "body") -> DataFrame:
    """Atom feeds."""
    entry = "struct<id:string,title:string,summary:string,published:string,author:array<struct<name:string>>,category:array<struct<_term:string>>>"
    rows = feeds.select(*feeds.drop(body).columns, F.posexplode(F.from_xml(body, f"entry array<{entry}>")["entry"]).alias("pos", "w"))
    w = F.col("w")
    day = F.substring(w["published"], 1, 10)
    return rows.select(*feeds.drop(body).columns, "pos", *document("preprints", w["id"], text.collapse(w["title"]), text.collapse(w["summary"]), text.parse_date(day), w["id"], authors=first_names(w["author"], "name"), concepts=first_names(w["category"], "_term")))


def news(pages: DataFrame, body: str = "body") -> DataFrame:
    """News lists: English only (blank passes), each url once a frame, with the frame's mean tone."""
    schema = "articles array<struct<url:string,title:string,seendate:string,domain:string,language:string>>, timeline array<struct<data:array<struct<value:double>>>>"
    parsed = pages.withColumn("p", F.from_json(body, schema))
    values = F.flatten(F.transform("p.timeline", lambda t: F.transform(t["data"], lambda v: v["value"])))
    rows = parsed.withColumn("tone", F.when(F.size(values) > 0, F.aggregate(values, F.lit(0.0), lambda a, x: a + x) / F.size(values)))
    rows = rows.select(*pages.drop(body).columns, "tone", F.posexplode("p.articles").alias("pos", "w"))
    w = F.col("w")
    rows = rows.where(F.lower(F.trim(F.coalesce(w["language"], F.lit("")))).isin("", "english", "en"))
    found = rows.select(*pages.drop(body).columns, "pos", *document("news", w["url"], w["title"], date=text.parse_date(w["seendate"]), url=w["url"], venue=w["domain"], tone=F.col("tone")))
    return found.dropDuplicates(["doc_id"])


def datasets(pages: DataFrame, body: str = "body") -> DataFrame:
    """Catalogue searches."""
    schema = "result struct<results:array<struct<id:string,title:string,notes:string,metadata_created:string,metadata_modified:string,organization:struct<title:string>,tags:array<struct<name:string>>>>>"
    rows = pages.select(*pages.drop(body).columns, F.posexplode(F.from_json(body, schema)["result"]["results"]).alias("pos", "w"))
    w = F.col("w")
    day = text.parse_date(F.substring(F.coalesce(w["metadata_modified"], w["metadata_created"]), 1, 10))
    return rows.select(*pages.drop(body).columns, "pos", *document("datasets", w["id"], w["title"], text.strip_markup(w["notes"], entities_first=False), day, venue=w["organization"]["title"], concepts=first_names(w["tags"], "name")))


def releases(feeds: DataFrame, body: str = "body") -> DataFrame:
    """RSS items."""
    item = "struct<title:string,link:string,guid:string,description:string,pubDate:string,category:array<string>>"
    rows = feeds.select(*feeds.drop(body).columns, F.posexplode(F.from_xml(body, f"channel struct<item:array<{item}>>")["channel"]["item"]).alias("pos", "w"))
    w = F.col("w")
    day = F.to_date(F.try_to_timestamp(F.regexp_extract(w["pubDate"], r"(\d{1,2} \w{3} \d{4})", 1), F.lit("d MMM yyyy")))
    return rows.select(*feeds.drop(body).columns, "pos", *document("releases", F.coalesce(w["guid"], w["link"]), w["title"], text.strip_markup(w["description"], entities_first=False), day, w["link"], concepts=w["category"]))


def patents(pages: DataFrame, body: str = "body") -> DataFrame:
    """Keyset-paged grants."""
    schema = "patents array<struct<patent_id:string,patent_title:string,patent_abstract:string,patent_date:string,patent_num_times_cited_by_us_patents:int,assignees:array<struct<assignee_organization:string>>,inventors:array<struct<inventor_name_last:string>>>>"
    rows = pages.select(*pages.drop(body).columns, F.posexplode(F.from_json(body, schema)["patents"]).alias("pos", "w"))
    w = F.col("w")
    return rows.select(*pages.drop(body).columns, "pos", *document("patents", w["patent_id"], w["patent_title"], w["patent_abstract"], text.parse_date(w["patent_date"]), authors=first_names(w["inventors"], "inventor_name_last"), institutions=first_names(w["assignees"], "assignee_organization"), citations=w["patent_num_times_cited_by_us_patents"]))


PARSERS = {"works": works, "articles": articles, "preprints": preprints, "news": news, "datasets": datasets, "releases": releases, "patents": patents}


def relevant(rows: DataFrame, frame: str, score: str = "score", anchor: int = 10, share: float = 0.2) -> DataFrame:
    """A frame's rows up to the first under the floor, a share of the score at the anchor's place (or the last, if fewer)."""
    whole = Window.partitionBy(frame)
    n = F.count(F.lit(1)).over(whole)
    place = F.row_number().over(whole.orderBy("pos"))
    rows = rows.withColumns({"_n": n, "_p": place})
    floor = F.coalesce(F.max(F.when(F.col("_p") == F.least(F.lit(anchor), F.col("_n")), F.col(score))).over(whole) * share, F.lit(0.0))
    rows = rows.withColumn("_low", F.coalesce(F.col(score) < floor, F.lit(False)))
    cut = F.max("_low").over(whole.orderBy("pos").rowsBetween(Window.unboundedPreceding, 0))
    return rows.withColumn("_cut", cut).where("not _cut").drop("_n", "_p", "_low", "_cut")
