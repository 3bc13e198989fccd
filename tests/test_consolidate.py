"""Transaction files end to end: eleven cases, in file order and shuffled, plain and gzip."""

import gzip
import random

import pytest

from terralot.operators.consolidate import broken_runs, consolidate
from terralot.sources.lines import HEADER, counters, read_raw, to_lines


def line(mid, parcel, **more):
    row = dict.fromkeys(HEADER, "") | {"id_mutation": mid, "id_parcelle": parcel, "date_mutation": "2024-03-05", "nature_mutation": "Vente", "code_commune": "01053", "code_departement": "01"} | more
    return [row[c] for c in HEADER]


def cases():
    at = lambda lon: {"longitude": str(lon), "latitude": "45.5"}
    flat = {"type_local": "Appartement"}
    return [
        line("S-01", "P1", valeur_fonciere="250000", type_local="Maison", surface_reelle_bati="100", nombre_pieces_principales="4", surface_terrain="500", **at(5.9)),
        line("S-01", "P2", valeur_fonciere="250000", type_local="Dépendance"), line("S-01", "P3", valeur_fonciere="250000", surface_terrain="350"),
        line("S-02", "P10", type_local="Maison", surface_reelle_bati="60"), line("S-02", "P11", type_local="Dépendance", **at(5.91)),
        line("S-03", "P20", surface_reelle_bati="50", nombre_pieces_principales="2", **flat),
        line("S-04", "P20", type_local="Maison", surface_reelle_bati="80", **at(5.92)),
        line("S-05", "P50", surface_reelle_bati="37", nombre_pieces_principales="1", lot1_surface_carrez="31.57", surface_terrain="120", **flat, **at(5.93)),
        line("S-05", "P50", surface_reelle_bati="37", nombre_pieces_principales="1", lot1_surface_carrez="31.57", surface_terrain="250", **flat, **at(5.93)),
        *[line("S-06", "P60", surface_reelle_bati="42", nombre_pieces_principales="2", **flat, **at(5.94)) for _ in range(2)],
        line("S-07", "P70", type_local="Local industriel", surface_reelle_bati="100", **at(5.95)), line("S-07", "P70", type_local="Maison", surface_reelle_bati="100", **at(5.95)),
        line("S-08", "P80", type_local="Dépendance", surface_reelle_bati="20", **at(5.96)),
        *[line("S-09", "P90", surface_reelle_bati=str(b), nombre_pieces_principales=p, **flat, **at(5.97)) for b, p in ((30, "1"), (35, "2"), (40, "2"))],
        line("S-10", "P100", surface_terrain="1000", **at(5.98)),
        line("S-11", "P110", nature_mutation="Vente en l'état futur d'achèvement", valeur_fonciere="118750.49", type_local="Appartement", **at(5.99)),
        line("", "P120"),
    ]


#: id: type, sb, st, np, items, nature, price
EXPECTED = {
    "S-01": (1, 100, 850, 4, 2, 1, 250000), "S-03": (2, 50, 0, 2, 1, 1, None), "S-04": (1, 80, 0, 0, 1, 1, None), "S-05": (2, 37, 250, 1, 1, 1, None), "S-06": (2, 84, 0, 4, 2, 1, None), "S-07": (1, 200, 0, 0, 2, 1, None),
    "S-08": (5, 0, 0, 0, 1, 1, None), "S-09": (3, 105, 0, 5, 3, 1, None), "S-10": (None, 0, 1000, 0, 0, 1, None), "S-11": (2, 0, 0, 0, 1, 2, 118750),
}


def write(path, rows, opener=open):
    with opener(path, "wt", encoding="utf-8") as f:
        f.write("﻿" + ",".join(HEADER) + "\n" + "".join(",".join(r) + "\n" for r in rows))
    return str(path)


def results(spark, path):
    kept, rejected = consolidate(to_lines(read_raw(spark, path)))
    return {r["id"]: r for r in kept.collect()}, [r["id"] for r in rejected.collect()]


@pytest.mark.parametrize("how", ["plain", "gzip", "shuffled"])
def test_cases(spark, tmp_path, how):
    rows = cases()
    if how == "shuffled":  # lines of one transaction keep their order
        keys = [r[0] for r in rows]
        random.Random(3).shuffle(keys)
        by = {k: [r for r in rows if r[0] == k] for k in set(keys)}
        rows = [by[k].pop(0) for k in keys]
    path = write(tmp_path / ("a.csv.gz" if how == "gzip" else "a.csv"), rows, gzip.open if how == "gzip" else open)
    kept, rejected = results(spark, path)
    assert rejected == ["S-02"]
    assert {k: (r["type"], r["sb"], r["st"], r["np"], r["nl"], r["nat"], r["vf"]) for k, r in kept.items()} == EXPECTED
    assert kept["S-01"]["com"] == "01053" and kept["S-01"]["dep"] == "01" and kept["S-01"]["date"] == 20240305
    assert kept["S-03"]["lon"] == 5.92
    assert [b["surfTerrain"] for b in kept["S-05"]["biens"]] == [370.0]
    assert [b["type"] for b in kept["S-07"]["biens"]] == ["Maison", "Local industriel"]
    assert sum(r["bare_lines"] for r in kept.values()) == 3
    runs = broken_runs(to_lines(read_raw(spark, path))).count()
    assert (runs > 0) == (how == "shuffled")


def test_counters(spark, tmp_path):
    path = write(tmp_path / "b.csv", [["a", "b"], line("", "P1"), line("X", "P2")])
    c = counters(read_raw(spark, path).cache()).first()
    assert (c["lines"], c["malformed"], c["skipped"]) == (3, 1, 1)


def test_missing_columns(spark, tmp_path):
    (tmp_path / "c.csv").write_text("a,b\n1,2\n")
    with pytest.raises(ValueError, match="missing"):
        read_raw(spark, str(tmp_path / "c.csv"))
