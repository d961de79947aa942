"""Loaders over SQLite databases in the sources' own shape, against a lookup for each key."""

import random
import sqlite3

import pytest

from tallyloom.operators import loaders
from tallyloom.sources.sqlite import sqlite_table


def database(path, tables):
    c = sqlite3.connect(path)
    for name, (columns, rows) in tables.items():
        c.execute(f"create table {name} ({columns})")
        if rows:
            c.executemany(f"insert into {name} values ({', '.join('?' * len(rows[0]))})", rows)
    c.commit()
    c.row_factory = sqlite3.Row
    return c


@pytest.fixture(scope="module")
def staff(tmp_path_factory):
    """Employees whose rates and departments come in any order; one without pay, one without a department, one who left."""
    r = random.Random(2)
    ids = list(range(1, 30))
    path = str(tmp_path_factory.mktemp("db") / "staff.db")
    tables = {
        "HumanResources_Employee": ("BusinessEntityID text, JobTitle text, HireDate text, BirthDate text, NationalIDNumber text, SalariedFlag text, Gender text, VacationHours text, SickLeaveHours text, CurrentFlag text",
                                    [(str(k), " Buyer  II ", "2009-01-14", "1969-01-29T00:00:00", str(10**8 + k), str(k % 2), "M", str(k), "" if k == 3 else "7", "0" if k == 5 else "1") for k in ids]),
        "HumanResources_EmployeePayHistory": ("BusinessEntityID text, RateChangeDate text, Rate text, PayFrequency text", [(str(k), f"20{n:02d}-02-{1 + k % 28:02d}", f"{r.randrange(10**5) / 1000:.3f}", str(1 + n % 2)) for k in ids if k != 7 for n in r.sample(range(1, 20), r.randint(1, 4))]),
        "HumanResources_EmployeeDepartmentHistory": ("BusinessEntityID text, DepartmentID text, ShiftID text, StartDate text, EndDate text", [(str(k), str(r.randint(1, 4)), str(r.randint(1, 3)), f"20{n:02d}-01-01", r.choice([None, f"20{n:02d}-12-31"])) for k in ids if k != 8 for n in r.sample(range(1, 20), r.randint(1, 3))]),
        "HumanResources_Department": ("DepartmentID text, Name text", [("1", "Sales"), ("2", "Tool  Design"), ("3", "Production")]),
        "HumanResources_Shift": ("ShiftID text, Name text", [("1", "Day"), ("2", "Evening"), ("3", "Night")]),
        "Person_Person": ("BusinessEntityID text, FirstName text, LastName text", [(str(k), "Ann", f"Lee{k}") for k in ids if k != 9]),
    }
    return path, database(path, tables)


def test_employees(spark, staff):
    path, c = staff
    got = {r.emp: r for r in loaders.employees(lambda t: sqlite_table(spark, path, t)).collect()}
    assert set(got) == set(range(1, 30)) - {5}
    for k, r in got.items():
        pay = c.execute("select * from HumanResources_EmployeePayHistory where BusinessEntityID = ? order by RateChangeDate desc limit 1", [str(k)]).fetchone()
        held = c.execute("select d.Name as d, s.Name as s from HumanResources_EmployeeDepartmentHistory h join HumanResources_Department d on d.DepartmentID = h.DepartmentID join HumanResources_Shift s on s.ShiftID = h.ShiftID where BusinessEntityID = ? order by (EndDate is null) desc, StartDate desc limit 1", [str(k)]).fetchone()
        assert (r.pay_frequency is None) == (pay is None) and (pay is None or (abs(float(r.pay_rate) - float(pay["Rate"])) <= 0.005 and r.pay_frequency == int(pay["PayFrequency"])))
        assert (r.department, r.shift) == ((" ".join(held["d"].split()), held["s"]) if held else ("", ""))
        assert (r.name, r.job_title, str(r.birth_date), r.vacation_hours, r.sick_hours, r.salaried) == ("" if k == 9 else f"Ann Lee{k}", "Buyer II", "1969-01-29", k, 0 if k == 3 else 7, k % 2 == 1)


def test_track_invoices(spark, tmp_path):
    path = f"{tmp_path}/music.db"
    tables = {
        "Invoice": ("InvoiceId integer, CustomerId integer, InvoiceDate text", [(1, 1, "2009-01-01 00:00:00"), (2, 2, "2009-01-02 00:00:00"), (3, 1, "x")]),
        "InvoiceLine": ("InvoiceLineId integer, InvoiceId integer, TrackId integer, UnitPrice real, Quantity integer", [(12, 1, 2, 0.99, 1), (9, 1, 1, 1.99, 2), (10, 1, 3, 0.99, 1), (11, 2, 4, 0.99, 5)]),
        "Track": ("TrackId integer, Name text, AlbumId integer, MediaTypeId integer, GenreId integer", [(1, " Go  on ", 1, 1, 1), (2, "No genre", 1, 1, None), (3, "No album", 9, 1, 1), (4, "No medium", 1, 9, 1)]),
        "Album": ("AlbumId integer, Title text, ArtistId integer", [(1, "First", 1)]), "Artist": ("ArtistId integer, Name text", [(1, "Who")]), "MediaType": ("MediaTypeId integer, Name text", [(1, "MPEG")]), "Genre": ("GenreId integer, Name text", [(1, "Rock")]),
        "Customer": ("CustomerId integer, FirstName text, LastName text, SupportRepId integer", [(1, "A", "B", 3), (2, "C", "D", None)]), "Employee": ("EmployeeId integer, FirstName text, LastName text", [(3, "E", "F")]),
    }
    database(path, tables)
    heads, lines = loaders.track_invoices(lambda t: sqlite_table(spark, path, t))
    assert sorted((r.invoice, str(r.order_date), r.customer, r.customer_code, r.salesperson) for r in heads.collect()) == [(1, "2009-01-01", "A B", "C00001", "E F"), (2, "2009-01-02", "C D", "C00002", ""), (3, "None", "A B", "C00001", "E F")]
    assert sorted((r.invoice, r.line_no, r.sku, r.description, r.quantity, str(r.unit_price), r.unit, r.category, r.details) for r in lines.collect()) == [
        (1, 1, "T00001", "Go on", 2, "1.99", "MPEG", "Rock", "Who · First"), (1, 2, "T00002", "No genre", 1, "0.99", "MPEG", "", "Who · First")]
