"""Small input files with the awkward rows the loads must cope with."""

from __future__ import annotations

import datetime as dt
import json
from pathlib import Path

FIRST = dt.date(2020, 1, 22)
DAYS = 50


def days(n: int = DAYS) -> list[dt.date]:
    return [FIRST + dt.timedelta(days=i) for i in range(n)]


def label(day: dt.date) -> str:
    return f"{day.month}/{day.day}/{day:%y}"


def _write(path: Path, lines: list[list[object]], sep: str = ",") -> str:
    def cell(v):
        text = "" if v is None else str(v)
        return f'"{text}"' if sep in text else text

    path.write_text("\n".join(sep.join(cell(v) for v in line) for line in lines) + "\n")
    return str(path)


COUNTIES = [
    # UID, county, state, start, daily growth of confirmed, of deaths
    (84001001, "Autauga", "Alabama", 0, 3, 0),
    (84001003, "Baldwin", "Alabama", 5, 2, 1),
    (84002013, "Aleutians East", "Alaska", 0, 0, 0),
    (84006001, "Alameda", "California", 100, 11, 2),
]


def confirmed(county, i: int) -> int:
    # one correction downwards makes an increment negative
    return county[3] + county[4] * i - (4 if i == 40 and county[4] else 0)


def deaths(county, i: int) -> int:
    return county[5] * (i // 2)


def us_files(folder: Path, n: int = DAYS) -> tuple[str, str]:
    ids = ["UID", "iso2", "iso3", "code3", "FIPS", "Admin2", "Province_State", "Country_Region", "Lat", "Long_"]
    header = [label(d) for d in days(n)]
    c_lines, d_lines = [[*ids, "Combined_Key", *header]], [[*ids, "Combined_Key", "Population", *header]]
    for county in COUNTIES:
        uid, name, state = county[:3]
        place = [uid, "US", "USA", 840, float(uid % 100000), name, state, "US", 32.5, -86.6, f"{name}, {state}, US"]
        c_lines.append([*place, *(confirmed(county, i) for i in range(n))])
        d_lines.append([*place, 1000 + uid % 1000, *(deaths(county, i) for i in range(n))])
    return _write(folder / "us_confirmed.csv", c_lines), _write(folder / "us_deaths.csv", d_lines)


COUNTRIES = {"Albania": (0, 2, 1), "Italy": (3, 40, 5), "US": (105, 16, 3)}


def global_files(folder: Path, n: int = DAYS) -> tuple[str, str]:
    header = ["Province/State", "Country/Region", "Lat", "Long", *(label(d) for d in days(n))]
    c_lines, d_lines = [header], [header]
    for name, (start, up, dead) in COUNTRIES.items():
        place = [None, name, 41.15, 20.17]
        c_lines.append([*place, *(start + up * i for i in range(n))])
        d_lines.append([*place, *(dead * (i // 3) for i in range(n))])
    # only reported by province, a province beside its country, a country without position
    for place in ([["Hubei", "China", 30.9, 112.2], ["Sicily", "Italy", 37.5, 14.0], [None, "Diamond Princess", None, None]]):
        c_lines.append([*place, *([7] * n)])
        d_lines.append([*place, *([1] * n)])
    return _write(folder / "global_confirmed.csv", c_lines), _write(folder / "global_deaths.csv", d_lines)


def country_file(folder: Path) -> str:
    names = "code;Name;Continent;Region;SurfaceArea;IndepYear;Population;LifeExpectancy;GNP;LocalName;GovernmentForm;HeadOfState;Capital;Code2"
    lines = [
        names,
        "ALB;Albania;Europe;Southern Europe;28748.0;1912;3401200;71.6;3205;Shqipëria;Republic;Rexhep Mejdani;34;AL",
        "ITA;Italy;Europe;Southern Europe;301316.0;1861;57680000;79.0;1161755;Italia;Republic;Carlo A. Ciampi;1464;IT",
        "ATA;Antarctica;Antarctica;Antarctica;13120000.0;;0;;0;–;Co-administrated;;;AQ",
    ]
    path = folder / "world_country.csv"
    path.write_text("\n".join(lines) + "\n")
    return str(path)


def index_file(folder: Path, n: int = DAYS) -> str:
    lines: list[list[object]] = [["date", "djia", "nasdaq100", "sp500"]]
    for i, day in enumerate(days(n)):
        if day.weekday() >= 5:
            continue
        # the first days have no level yet, one holiday has none
        gone = i < 2 or i == 20
        lines.append([day, *([None, ".", None] if gone else [29000.0 - i, 9000.0 + i, 3300.5 - i])])
    return _write(folder / "indexes.csv", lines)


def series_file(folder: Path, months: int = 6) -> str:
    lines: list[list[object]] = [["date", "unrate", "payems", "LNU04032215", "LNU04032218"]]
    for i in range(months):
        day = dt.date(2019 + (10 + i) // 12, (10 + i) % 12 + 1, 1)
        lines.append([day, 3.5 + i / 4, None if i == 2 else 150000 - 10 * i, 2.0 + i, 9.0 - i])
    return _write(folder / "series.csv", lines)


PRICES_HEADER = "Date,High,Low,Open,Close,Volume,Adj Close"


def price_files(folder: Path) -> str:
    target = folder / "prices"
    target.mkdir()
    good = [f"{d},{10 + i},{8 + i},{9 + i},{9.5 + i},{1000 + i},{9.4 + i}" for i, d in enumerate(days(60))]
    (target / "AAA.csv").write_text("\n".join([PRICES_HEADER, *good]) + "\n")
    broken = ["2020-01-23,1,2,3,4,5,6", "2020-01-24,oops,2,3,4,5,6", "2020-01-27,1,2,,4,5,6", "garbage"]
    (target / "BBB.csv").write_text("\n".join([PRICES_HEADER, *broken]) + "\n")
    (target / "DDD.csv").write_text(PRICES_HEADER + "\n")
    return str(target)


def series_json(folder: Path, year: int) -> str:
    def point(period, value, *notes):
        return {"year": str(year), "period": period, "value": value, "footnotes": [{"text": n} for n in notes] or [{}]}

    data = [point("M01", "3.5"), point("M02", "3.6", "preliminary", "revised"), point("M13", "3.55")]
    series = [{"seriesID": "unrate", "data": data}, {"seriesID": "payems", "data": [point("M02", "-")]}]
    target = folder / "answers"
    target.mkdir(exist_ok=True)
    (target / f"{year}.json").write_text(json.dumps({"status": "ok", "Results": {"series": series}}, indent=1))
    return str(target)


def ticker_page() -> str:
    def line(*cells):
        return "<tr>" + "".join(f"<td>{c}\n</td>" for c in cells) + "</tr>"

    return (
        "<html><table class='x'><tr><td>nothing</td></tr></table>"
        '<table class="wikitable sortable" id="constituents"><tbody>\n<tr>\n<th>Symbol</th><th>Security</th></tr>\n'
        + line('<a href="/a">AAA</a>', "A &amp; A", "reports", "Tech", "Chips", "Here", "1999", "0000000001", "1976")
        + line("BBB", "Bee", "reports", "Energy", "Oil", "There", "2001", "0000000002", "1881 (1900)")
        + line("CCC", "Sea", "reports", "Energy", "Oil", "There", "", "0000000003", "2001")
        + "</tbody></table>"
        '<table class="wikitable sortable"><tr><td>second table</td></tr></table></html>'
    )
