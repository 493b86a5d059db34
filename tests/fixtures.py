"""Tiny landing files, each row hitting one rule (see FIXTURES.md)."""

from __future__ import annotations

import csv
import os

HEADER = ["", "ID", "Case Number", "Date", "Block", "IUCR", "Primary Type", "Description",
          "Location Description", "Arrest", "Domestic", "Beat", "District", "Ward",
          "Community Area", "FBI Code", "X Coordinate", "Y Coordinate", "Year", "Updated On",
          "Latitude", "Longitude", "Location"]

BASE = {"ID": "1", "Case Number": "HX1", "Date": "05/03/2016 11:40:00 PM", "Block": "001XX N STATE ST",
        "IUCR": "0486", "Primary Type": "BATTERY", "Description": "DOMESTIC BATTERY SIMPLE",
        "Location Description": "STREET", "Arrest": "False", "Domestic": "True", "Beat": "1234.0",
        "District": "12.0", "Ward": "27.0", "Community Area": "25.0", "FBI Code": "08B",
        "X Coordinate": "1170000.0", "Y Coordinate": "1900000.0", "Year": "2016",
        "Updated On": "05/10/2016 03:56:50 PM", "Latitude": "41.8", "Longitude": "-87.7",
        "Location": "(41.8, -87.7)"}


def row(**kw):
    r = dict(BASE)
    for k, v in kw.items():
        r[k.replace("_", " ")] = v
    return r


def crimes_rows():
    R = []
    R.append(row(ID="1"))                                               # plain
    R.append(row(ID="2", Date="01/01/2016 12:00:00 AM"))                # midnight
    R.append(row(ID="3", Description="OLD", Updated_On="01/01/2016 10:00:00 AM"))
    R.append(row(ID="3", Description="NEW", Updated_On="02/01/2016 10:00:00 AM"))  # dup, later
    R.append(row(ID="10.0"))                                            # -> 10
    R.append(row(ID="abc"))                                             # removed
    R.append(row(ID=""))                                                # removed (null)
    R.append(row(ID="20", Date="bad"))                                  # removed
    R.append(row(ID="21", Year="2011"))
    R.append(row(ID="22", Year="2018"))
    R.append(row(ID="23", Year=""))
    R.append(row(ID="30", Latitude="0", Longitude="0"))                 # (0,0)
    R.append(row(ID="31", Latitude="40.0", Longitude="-87.7"))          # out of box
    R.append(row(ID="32", Latitude="41.8", Longitude=""))               # lon missing
    R.append(row(ID="33", Latitude="", Longitude=""))                   # both missing
    R.append(row(ID="34", Latitude="41.60", Longitude="-87.95"))        # box edge
    R.append(row(ID="40", Beat="1e12"))
    R.append(row(ID="41", Beat="x"))
    R.append(row(ID="42", Beat="6.0"))
    R.append(row(ID="50", IUCR="110", Primary_Type="HOMICIDE", Description="FIRST DEGREE MURDER",
                 FBI_Code="01A"))
    R.append(row(ID="51", IUCR=" 0110 ", Primary_Type="HOMICIDE",
                 Description="FIRST DEGREE MURDER", FBI_Code="01A"))
    R.append(row(ID="52", IUCR="041A", Primary_Type="BATTERY", Description="AGGRAVATED"))
    R.append(row(ID="53", IUCR="12345", Primary_Type="OTHER", Description="LONG CODE"))
    R.append(row(ID="54", IUCR=""))                                     # null code -> -1
    # code 0820: two primary types 2:1
    R.append(row(ID="60", IUCR="0820", Primary_Type="THEFT", Description="$500 AND UNDER",
                 FBI_Code="06"))
    R.append(row(ID="61", IUCR="0820", Primary_Type="THEFT", Description="$500 AND UNDER",
                 FBI_Code="06"))
    R.append(row(ID="62", IUCR="0820", Primary_Type="DECEPTIVE PRACTICE",
                 Description="$500 AND UNDER", FBI_Code="06"))
    # code 0530: tie 1:1 -> first by (type, description, fbi)
    R.append(row(ID="63", IUCR="0530", Primary_Type="ROBBERY", Description="ARMED", FBI_Code="03"))
    R.append(row(ID="64", IUCR="0530", Primary_Type="ASSAULT", Description="ARMED", FBI_Code="04A"))
    R.append(row(ID="65", IUCR="9999", Primary_Type="NEW TYPE", Description="NOT IN REFERENCE"))
    R.append(row(ID="70", Community_Area="0"))
    R.append(row(ID="71", Community_Area=""))
    R.append(row(ID="72", Community_Area="78"))
    R.append(row(ID="80", Location_Description=""))
    R.append(row(ID="81", Location_Description=" STREET "))
    R.append(row(ID="82", Location_Description="DESCONHECIDO"))
    R.append(row(ID="90", Arrest=""))
    R.append(row(ID="91", Arrest="true"))
    R.append(row(ID="92", Arrest="True"))
    R.append(row(ID="95", Block='123 "MAIN" ST\nAPT 4'))              # quoted newline and quote
    return R


def socio_rows():
    rows = []
    for ca in range(1, 78):
        income = 8000 + 1000 * ca
        hardship = 98 - ca
        if ca == 11:
            income = 8000 + 1000 * 10      # tie with area 10
        if ca == 21:
            hardship = 98 - 20             # tie with area 20
        rows.append([str(ca), f"Area {ca}", "4.5", f"{10 + ca % 40}.5", "9.1", "12.0", "30.2",
                     str(income), str(hardship)])
    rows.append(["", "CITY TOTAL", "4.7", "19.7", "12.9", "19.5", "33.5", "28202", ""])
    return rows


SOCIO_HEADER = ["ca", "community_area_name", "percent_of_housing_crowded",
                "percent_households_below_poverty", "percent_aged_16_unemployed",
                "percent_aged_25_without_high_school_diploma", "percent_aged_under_18_or_over_64",
                "per_capita_income_", "hardship_index"]

IUCR_HEADER = ["iucr", "primary_description", "secondary_description", "index_code"]
IUCR_ROWS = [["110", "HOMICIDE", "FIRST DEGREE MURDER", "I"],
             ["0460", "BATTERY", "SIMPLE", "N"],
             ["041A", "BATTERY", "AGGRAVATED: HANDGUN", " i "],
             ["0110", "HOMICIDE", "DUPLICATE ROW", "I"],
             ["0486", "BATTERY", "DOMESTIC BATTERY SIMPLE", ""],
             ["0820", "THEFT", "$500 AND UNDER", "I"],
             ["0530", "ASSAULT", "AGGRAVATED", "I"]]


def _write(path, header, rows):
    with open(path, "w", newline="") as f:
        w = csv.writer(f, quoting=csv.QUOTE_MINIMAL)
        w.writerow(header)
        for r in rows:
            w.writerow(r)


def write_landing(d: str, reverse: bool = False) -> dict[str, str]:
    crimes = [[str(i)] + [r[h] for h in HEADER[1:]] for i, r in enumerate(crimes_rows())]
    if reverse:  # same records, opposite file order (and index column)
        crimes = crimes[::-1]
    paths = {"crimes": os.path.join(d, "crimes.csv"),
             "socioeconomic": os.path.join(d, "socioeconomic.csv"),
             "iucr_codes": os.path.join(d, "iucr_codes.csv")}
    _write(paths["crimes"], HEADER, crimes)
    _write(paths["socioeconomic"], SOCIO_HEADER, socio_rows())
    _write(paths["iucr_codes"], IUCR_HEADER, IUCR_ROWS)
    return paths
