"""Normalised records from the tables of source databases: all records at once, where a lookup for each key is usual.

A loader takes `tables`, which gives a table by its name: from SQLite, from Parquet or from views. Values come as text or as
typed columns; loaders cast what they need, and what can't be cast is null."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import text
from ..functions.draws import below, draw_sql
from ..registry import query
from ..sources.tables import read

Tables = Callable[[str], DataFrame]


def day(c: str) -> Column:
    """A date from text with or without a time; null if it is none."""
    return F.to_date(F.substring(F.trim(F.replace(F.col(c).cast("string"), F.lit("T"), F.lit(" "))), 1, 10).try_cast("date"))


def whole(c: str) -> Column:
    return F.col(c).cast("string").try_cast("decimal(24,6)").cast("long")


def rounded(c: str) -> Column:
    """Two places, half to even; null and empty count as nothing."""
    return F.bround(F.coalesce(F.nullif(F.col(c).cast("string"), F.lit("")).try_cast("decimal(24,6)"), F.lit(0).cast("decimal(24,6)")), 2).cast("decimal(18,2)")


def first_of_each(rows: DataFrame, key: str, *order: Column) -> DataFrame:
    """The first row of each key in an order, which ends in all other columns so that ties have one answer."""
    rest = [F.col(c) for c in rows.columns if c != key]
    return rows.withColumn("f_n", F.row_number().over(Window.partitionBy(key).orderBy(*order, *rest))).filter("f_n = 1").drop("f_n")


def employees(tables: Tables) -> DataFrame:
    """Current employees with their latest pay, their present department and shift, and their name.

    The present department is the one without an end date, else the one begun last. Who has no pay, department or person
    stays, with nulls or empty texts."""
    e = tables("HumanResources_Employee").filter(F.trim(F.col("CurrentFlag").cast("string")).isin("1", "true"))
    e = e.select(
        whole("BusinessEntityID").alias("emp"), text.clean(F.col("JobTitle")).alias("job_title"), day("HireDate").alias("hire_date"), day("BirthDate").alias("birth_date"), text.clean(F.col("NationalIDNumber").cast("string")).alias("national_id"),
        F.trim(F.col("SalariedFlag").cast("string")).isin("1", "true").alias("salaried"), text.clean(F.col("Gender")).alias("gender"), F.coalesce(whole("VacationHours"), F.lit(0)).alias("vacation_hours"), F.coalesce(whole("SickLeaveHours"), F.lit(0)).alias("sick_hours"))
    pay = tables("HumanResources_EmployeePayHistory").select(whole("BusinessEntityID").alias("p_emp"), F.col("RateChangeDate").cast("string").alias("changed"), rounded("Rate").alias("pay_rate"), whole("PayFrequency").alias("pay_frequency"))
    pay = first_of_each(pay, "p_emp", F.desc("changed")).drop("changed")
    held = tables("HumanResources_EmployeeDepartmentHistory").select(whole("BusinessEntityID").alias("h_emp"), whole("DepartmentID").alias("h_dept"), whole("ShiftID").alias("h_shift"), F.col("StartDate").cast("string").alias("begun"), F.nullif(F.col("EndDate").cast("string"), F.lit("")).alias("ended"))
    dept = tables("HumanResources_Department").select(whole("DepartmentID").alias("h_dept"), text.clean(F.col("Name")).alias("department"))
    shift = tables("HumanResources_Shift").select(whole("ShiftID").alias("h_shift"), text.clean(F.col("Name")).alias("shift"))
    held = held.join(dept, "h_dept").join(shift, "h_shift")
    held = first_of_each(held, "h_emp", F.col("ended").isNull().desc(), F.desc("begun")).select("h_emp", "department", "shift")
    who = tables("Person_Person").select(whole("BusinessEntityID").alias("w_emp"), text.clean(F.concat_ws(" ", "FirstName", "LastName")).alias("name"))
    rows = e.join(pay, F.col("emp") == F.col("p_emp"), "left").join(held, F.col("emp") == F.col("h_emp"), "left").join(who, F.col("emp") == F.col("w_emp"), "left")
    empty = lambda c: F.coalesce(c, F.lit("")).alias(c)
    return rows.select("emp", empty("name"), "job_title", empty("department"), empty("shift"), "hire_date", "birth_date", "national_id", "pay_rate", "pay_frequency", "salaried", "gender", "vacation_hours", "sick_hours")


def track_invoices(tables: Tables) -> tuple[DataFrame, DataFrame]:
    """Heads and lines of invoices of tracks. A line needs its track, album, artist and medium; its genre and the invoice's
    salesperson may be missing. Lines are in the order of their ids."""
    line = tables("InvoiceLine").select(whole("InvoiceId").alias("invoice"), whole("InvoiceLineId").alias("line"), whole("TrackId").alias("track_no"), whole("Quantity").alias("quantity"), rounded("UnitPrice").alias("unit_price"))
    track = tables("Track").select(whole("TrackId").alias("track_no"), text.clean(F.col("Name")).alias("description"), whole("AlbumId").alias("album_no"), whole("MediaTypeId").alias("media_no"), whole("GenreId").alias("genre_no"))
    album = tables("Album").select(whole("AlbumId").alias("album_no"), whole("ArtistId").alias("artist_no"), text.clean(F.col("Title")).alias("album"))
    named = lambda t, key, as_key, as_name: tables(t).select(whole(key).alias(as_key), text.clean(F.col("Name")).alias(as_name))
    artist, media, genre = named("Artist", "ArtistId", "artist_no", "artist"), named("MediaType", "MediaTypeId", "media_no", "unit"), named("Genre", "GenreId", "genre_no", "category")
    lines = line.join(track, "track_no").join(album, "album_no").join(artist, "artist_no").join(media, "media_no").join(genre, "genre_no", "left")
    n = F.row_number().over(Window.partitionBy("invoice").orderBy("line"))
    details = F.concat_ws(" · ", "artist", "album")
    lines = lines.select("invoice", n.cast("long").alias("line_no"), F.concat(F.lit("T"), text.padded(F.col("track_no"), 5)).alias("sku"), "description", "quantity", "unit_price", "unit", F.coalesce("category", F.lit("")).alias("category"), details.alias("details"))
    head = tables("Invoice").select(whole("InvoiceId").alias("invoice"), whole("CustomerId").alias("customer_no"), day("InvoiceDate").alias("order_date"))
    who = tables("Customer").select(whole("CustomerId").alias("customer_no"), text.clean(F.concat_ws(" ", "FirstName", "LastName")).alias("customer"), whole("SupportRepId").alias("rep_no"))
    rep = tables("Employee").select(whole("EmployeeId").alias("rep_no"), text.clean(F.concat_ws(" ", "FirstName", "LastName")).alias("salesperson"))
    heads = head.join(who, "customer_no").join(rep, "rep_no", "left")
    heads = heads.select("invoice", "order_date", "customer", F.concat(F.lit("C"), text.padded(F.col("customer_no"), 5)).alias("customer_code"), F.coalesce("salesperson", F.lit("")).alias("salesperson"))
    return heads, lines


TITLES = ("Buyer", "Designer", "Human Resources Manager", "Machinist")
_titles = f"({list(TITLES)})[({draw_sql('title', 's_suppkey')} % {len(TITLES)})::integer + 1]"


def staff_tables(spark: SparkSession, sf_dir: str) -> Tables:
    """Tables of employees made of suppliers, with one to three rates and one or two departments each, as text."""
    s = read(spark, sf_dir, "supplier")
    k, t = F.col("s_suppkey"), lambda x: x.cast("string")
    date = lambda first, n: F.date_add(F.lit(first).cast("date"), n.cast("int"))
    hired = date("2000-01-01", below(5000, "hired", k))
    several = lambda tag, n: s.select("s_suppkey", F.explode(F.sequence(F.lit(0).cast("long"), below(n, tag, k))).alias("n"))
    n = F.col("n")

    def give(name: str) -> DataFrame:
        if name == "HumanResources_Employee":
            title = F.get(F.array(*map(F.lit, TITLES)), below(len(TITLES), "title", k).cast("int"))
            return s.select(t(k).alias("BusinessEntityID"), title.alias("JobTitle"), t(hired).alias("HireDate"), F.concat(t(date("1960-01-01", below(12000, "born", k))), F.lit(" 00:00:00")).alias("BirthDate"), t(below(10**9, "national", k)).alias("NationalIDNumber"),
                            t(below(2, "salaried", k)).alias("SalariedFlag"), F.lit("F").alias("Gender"), t(below(100, "vacation", k)).alias("VacationHours"), t(below(70, "sick", k)).alias("SickLeaveHours"), t((below(10, "current", k) > 0).cast("int")).alias("CurrentFlag"))
        if name == "HumanResources_EmployeePayHistory":
            return several("rates", 3).select(t(k).alias("BusinessEntityID"), t(F.date_add(hired, (n * 400).cast("int"))).alias("RateChangeDate"), t((below(90000, "rate", k, n) / F.lit(1000).cast("decimal(4,0)")).cast("decimal(9,3)")).alias("Rate"), t(1 + below(2, "frequency", k)).alias("PayFrequency"))
        if name == "HumanResources_EmployeeDepartmentHistory":
            rows = several("moves", 2)
            ended = F.when(below(3, "ended", k, n) == 0, t(F.date_add(hired, (n * 300 + 299).cast("int"))))
            return rows.select(t(k).alias("BusinessEntityID"), t(below(5, "department", k, n)).alias("DepartmentID"), t(below(5, "shift", k, n)).alias("ShiftID"), t(F.date_add(hired, (n * 300).cast("int"))).alias("StartDate"), ended.alias("EndDate"))
        r = read(spark, sf_dir, "region")
        if name == "HumanResources_Department":
            return r.select(t(F.col("r_regionkey")).alias("DepartmentID"), F.col("r_name").alias("Name"))
        if name == "HumanResources_Shift":
            return r.select(t(F.col("r_regionkey")).alias("ShiftID"), F.concat(F.lit("Shift  "), "r_regionkey").alias("Name"))
        return s.filter(k % 9 > 0).select(t(k).alias("BusinessEntityID"), F.lit(" Sam").alias("FirstName"), F.col("s_name").alias("LastName"))

    return give


_hired = f"(date '2000-01-01' + ({draw_sql('hired', 's_suppkey')} % 5000)::integer)::date"


@query(f"""with pay as (select s_suppkey, ({_hired} + (n * 400)::integer)::date as changed, round_even(({draw_sql("rate", "s_suppkey", "n")} % 90000 / 1000.0)::decimal(9,3), 2)::decimal(18,2) as rate
    from (select s_suppkey, unnest(range(0, {draw_sql("rates", "s_suppkey")} % 3 + 1)) as n from supplier) qualify row_number() over (partition by s_suppkey order by changed desc) = 1),
held as (select s_suppkey as h_emp, d.r_name as department, 'Shift ' || f.r_regionkey as shift from (select s_suppkey, n, ({_hired} + (n * 300)::integer)::date as begun, {draw_sql("ended", "s_suppkey", "n")} % 3 = 0 as ended, {draw_sql("department", "s_suppkey", "n")} % 5 as dept, {draw_sql("shift", "s_suppkey", "n")} % 5 as sh
    from (select s_suppkey, unnest(range(0, {draw_sql("moves", "s_suppkey")} % 2 + 1)) as n from supplier)) join region d on d.r_regionkey = dept join region f on f.r_regionkey = sh qualify row_number() over (partition by s_suppkey order by ended, begun desc) = 1)
select s.s_suppkey as emp, case when s.s_suppkey % 9 > 0 then 'Sam ' || s_name else '' end as name, {_titles.replace("s_suppkey", "s.s_suppkey")} as job_title, coalesce(department, '') as department, coalesce(shift, '') as shift, {_hired.replace("s_suppkey", "s.s_suppkey")} as hire_date,
  (date '1960-01-01' + ({draw_sql("born", "s.s_suppkey")} % 12000)::integer)::date as birth_date, ({draw_sql("national", "s.s_suppkey")} % 1000000000)::varchar as national_id, rate as pay_rate, 1 + {draw_sql("frequency", "s.s_suppkey")} % 2 as pay_frequency,
  {draw_sql("salaried", "s.s_suppkey")} % 2 = 1 as salaried, 'F' as gender, {draw_sql("vacation", "s.s_suppkey")} % 100 as vacation_hours, {draw_sql("sick", "s.s_suppkey")} % 70 as sick_hours
from supplier s join pay on pay.s_suppkey = s.s_suppkey left join held on h_emp = s.s_suppkey where {draw_sql("current", "s.s_suppkey")} % 10 > 0""")
def load_employees(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Employees of tables in the source's own shape."""
    return employees(staff_tables(spark, sf_dir))


def track_tables(spark: SparkSession, sf_dir: str) -> Tables:
    """Tables of invoices of tracks: parts as tracks, suppliers as albums, nations as artists, regions as media."""
    t = lambda c: F.col(c).cast("string")
    p = F.col("p_partkey")

    def give(name: str) -> DataFrame:
        of = lambda table: read(spark, sf_dir, table)
        if name == "InvoiceLine":
            l = of("lineitem")
            key = F.row_number().over(Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "l_shipdate"))
            return l.select(t("l_orderkey").alias("InvoiceId"), key.alias("InvoiceLineId"), t("l_partkey").alias("TrackId"), t("l_quantity").alias("Quantity"), F.lit("0.995").alias("UnitPrice"))
        if name == "Track":
            many = of("supplier").agg(F.count(F.lit(1)).alias("n")).scalar()
            return of("part").select(t("p_partkey").alias("TrackId"), F.concat(F.lit(" "), "p_name").alias("Name"), (1 + p % many).cast("string").alias("AlbumId"), (p % 6).alias("MediaTypeId"), F.when(p % 4 > 0, p % 7).alias("GenreId"))
        if name == "Album":
            return of("supplier").select(t("s_suppkey").alias("AlbumId"), t("s_nationkey").alias("ArtistId"), F.col("s_name").alias("Title"))
        if name == "Artist":
            return of("nation").select(t("n_nationkey").alias("ArtistId"), F.col("n_name").alias("Name"))
        if name in ("MediaType", "Genre"):
            return of("region").select(t("r_regionkey").alias(f"{name}Id"), F.col("r_name").alias("Name"))
        if name == "Invoice":
            return of("orders").select(t("o_orderkey").alias("InvoiceId"), t("o_custkey").alias("CustomerId"), t("o_orderdate").alias("InvoiceDate"))
        if name == "Customer":
            return of("customer").select(t("c_custkey").alias("CustomerId"), F.lit("Kim").alias("FirstName"), F.col("c_name").alias("LastName"), F.when(F.col("c_custkey") % 5 > 0, F.col("c_nationkey")).alias("SupportRepId"))
        return of("nation").select(t("n_nationkey").alias("EmployeeId"), F.lit("Jo").alias("FirstName"), F.col("n_name").alias("LastName"))

    return give


_code = lambda letter, x: f"'{letter}' || lpad({x}::varchar, greatest(5, length({x}::varchar))::integer, '0')"


@query(f"""select o_orderkey as invoice, cast(o_orderdate as date) as order_date, 'Kim ' || c_name as customer, {_code("C", "c_custkey")} as customer_code, coalesce(case when c_custkey % 5 > 0 then 'Jo ' || n_name end, '') as salesperson
from orders join customer on c_custkey = o_custkey left join nation on n_nationkey = c_nationkey""")
def load_track_invoices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Heads of invoices of tracks, of tables in the source's own shape."""
    return track_invoices(track_tables(spark, sf_dir))[0]


@query(f"""with l as (select *, row_number() over (partition by l_orderkey order by l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_quantity, l_shipdate) as key from lineitem)
select l_orderkey as invoice, row_number() over (partition by l_orderkey order by key) as line_no, {_code("T", "p_partkey")} as sku, p_name as description, l_quantity::bigint as quantity, 1.00::decimal(18,2) as unit_price, m.r_name as unit, coalesce(g.r_name, '') as category, n_name || ' · ' || s_name as details
from l join part on p_partkey = l_partkey join supplier on s_suppkey = 1 + p_partkey % (select count(*) from supplier) join nation on n_nationkey = s_nationkey join region m on m.r_regionkey = p_partkey % 6 left join region g on p_partkey % 4 > 0 and g.r_regionkey = p_partkey % 7""")
def load_track_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Their lines: without a medium a line falls out, without a genre it stays."""
    return track_invoices(track_tables(spark, sf_dir))[1]
