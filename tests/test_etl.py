"""End to end: eight hand-written raw files -> eleven tables, report, views."""

import os

import pytest

from terroir.plans.etl import EtlConfig, attach, latest_run, run
from terroir.sources.delimited import SourceNotFoundError, read_delimited

ELECTION_HEADER = ("Code departement;Libelle departement;Code commune;Libelle commune;Code canton;"
                   "Libelle canton;Inscrits;Abstentions;Votants;Blancs;Nuls;Exprimes;"
                   "Code circonscription;Libelle circonscription;id_brut_miom")
T1_ROWS = [
    "69;Rhône;69001;lyon 1er arrondissement;;;1000;400;600;10;5;585;6901;1Ere circonscription;69_001_0001",
    "69;Rhône;69002;Saint-Germain-au-Mont-d'Or;;;500;100;400;5;5;390;6902;2Eme circonscription;69_002_1",
    "69;Rhône;69001;lyon 1er arrondissement;;;1000;400;600;10;5;585;6901;1Ere circonscription;69_001_0001",
    "69;Rhône;69003;Écully;;;100;0;200;0;0;200;6903;3Eme circonscription;69_003_1",
    "69;Rhône;69004;Bron;;;300;100;200;10;10;181;6904;4Eme circonscription;69_004_1",
    "69;Rhône;69005;Caluire;;;;10;20;1;1;18;6905;5Eme circonscription;69_005_1",
    "69;Rhône;69006;VÃ©nissieux;;;800;200;600;20;10;570;6906;6Eme circonscription;69_006_1",
    '69;Rhône;69007;"Lyon ""centre""";;;400;100;300;0;0;300;6907;7Eme circonscription;69_007_1',
]
T2_ROWS = [
    "69;Rhône;69001;lyon 1er arrondissement;;;1000;300;700;10;10;680;6901;1Ere circonscription;69_001_0001",
    "69;Rhône;69002;Saint-Germain-au-Mont-d'Or;;;500;50;450;5;5;440;6902;2Eme circonscription;69_002_1",
    "69;Rhône;69006;Vénissieux;;;800;100;700;20;10;670;6906;6Eme circonscription;69_006_1",
]
SECURITE = ("Code_departement;Code_region;annee;indicateur;unite_de_compte;nombre;taux_pour_mille;"
            "insee_pop;insee_pop_millesime;insee_log;insee_log_millesime\n"
            "69;84;2016;Homicides;Victime;23;0,0125279;1835903;2016;904462;2016\n"
            "69;84;2017;Homicides;Victime;20;0,01085;1843319;2017;914980;2017\n"
            "69;84;2017;Homicides;Victime;20;0,01085;1843319;2017;914980;2017\n"
            "1;84;2016;Homicides;Victime;5;0,001;600000;2016;300000;2016\n"
            "69;84;2018;Vols;Véhicule;ND;;1859524;2018;926576;2018\n")
EMPLOI = ("CODGEO;P22_POP1564;P22_POP1524\n69001;253,96;34,14\n69002;130,77;17,32\n69001;999;999\n"
          "01001;5;5\n69003;;\n6902969256;10;10\n6900;1;1\n")
REVENUS = ("CODGEO;Revenu médian par unité de consommation;Rapport d'inégalité\n"
           "69001;20200;4,2\n69019;25550;4,5\n69005;;\n6912369259;16190;10,2\n69001;1;1\n")
DIPLOMES = ("IRIS;COM;TYP_IRIS;LAB_IRIS;P22_NSCOL15P_DIPLMIN;Nombre élèves\n"
            "690010101;69001;H;1;12,5;3\n690010102;69001;H;1;;\n010010000;01001;Z;1;5;5\n"
            "690010101;69001;H;1;99;99\n690020101;69002;H;1;7;8\n")
LOGEMENT = ("IRIS;COM;TYP_IRIS;LAB_IRIS;P22_LOG;P22_RP\n690010101;69001;H;1;120;100\n"
            "690010102;69001;H;1;;\n690010101;69001;H;1;1;1\n690020101;69002;H;1;80;70\n")
IRIS = ("﻿codeiris;libelle;type;typelibelle;commune;insee;gid\n"
        "690290104;ferdinand buisson église;h;habitat;BRON;69029;1029\n"
        "690290201;  gérard philipe-ferdinand buisson ;H;Habitat;Bron;69029;1030\n"
        "690290104;dup;H;Habitat;Bron;69029;9999\n")


def write_inputs(d, securite_encoding="latin1"):
    def w(name, text, enc):
        with open(os.path.join(d, name), "w", encoding=enc, newline="") as f:
            f.write(text)
    w("Premier_tour_rhone_sep.csv", ELECTION_HEADER + "\n" + "\n".join(T1_ROWS) + "\n", "utf-8")
    w("Second_tour_rhone_sep.csv", ELECTION_HEADER + "\n" + "\n".join(T2_ROWS) + "\n", "utf-8")
    w("donnee-dep-data.gouv-2025-geographie2025-produit-le2026-01-22.csv", SECURITE, securite_encoding)
    w("emploi_et_pop-active_2022.CSV", EMPLOI, "latin1")
    w("data_revenus_2021.csv", REVENUS, "latin1")
    w("diplomes_et_formation-2022.CSV", DIPLOMES, "latin1")
    w("logement-2022.CSV", LOGEMENT, "latin1")
    w("contours-iris-metropole-lyon.csv", IRIS, "utf-8")


@pytest.fixture(scope="module")
def etl(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("etl")
    data = base / "data"
    data.mkdir()
    write_inputs(str(data))
    cfg = EtlConfig(str(data), str(base / "out"), str(base / "tables"), single_file_csv=True)
    return run(spark, cfg), cfg


def test_table_counts(etl):
    res, _ = etl
    counts = {k: v.count() for k, v in res.tables.items()}
    assert counts == {
        "fact_election_tour1": 4, "fact_election_tour2": 3, "fact_securite": 3,
        "fact_emploi_pop_active": 3, "fact_revenus": 4, "fact_diplomes": 2, "fact_logement": 2,
        "dim_iris_lyon": 2, "dim_commune": 6, "dim_departement": 1, "dim_temps": 3}


def test_quality_report(etl):
    res, _ = etl
    rows = {r.table_name: r.asDict() for r in res.report.collect()}
    assert list(rows) == ["fact_election_tour1", "fact_election_tour2", "fact_securite",
                          "fact_emploi_pop_active", "fact_revenus", "fact_diplomes",
                          "fact_logement", "dim_iris_lyon"]
    t1 = rows["fact_election_tour1"]
    assert (t1["rows_before"], t1["rows_after"], t1["rows_removed"], t1["duplicates_removed"]) == (8, 4, 4, 1)
    assert t1["columns_count"] == 13
    s = rows["fact_securite"]
    assert (s["rows_before"], s["rows_after"], s["duplicates_removed"], s["null_cells"]) == (5, 3, 1, 2)
    assert s["columns_count"] == 11
    e = rows["fact_emploi_pop_active"]
    assert (e["rows_before"], e["rows_after"], e["duplicates_removed"]) == (7, 3, 1)
    r = rows["fact_revenus"]
    assert (r["rows_before"], r["rows_after"], r["null_cells"]) == (5, 4, 2)
    assert rows["fact_diplomes"]["rows_after"] == 2 and rows["fact_diplomes"]["duplicates_removed"] == 1
    assert rows["dim_iris_lyon"]["rows_after"] == 2
    for v in rows.values():
        assert v["rows_removed"] == v["rows_before"] - v["rows_after"]


def test_election_values(etl):
    res, _ = etl
    t1 = {r.codgeo: r for r in res.tables["fact_election_tour1"].collect()}
    assert sorted(t1) == ["69001", "69002", "69006", "69007"]
    assert t1["69006"].libelle_commune == "Venissieux"
    assert t1["69002"].libelle_commune == "Saint-Germain-Au-Mont-D'Or"
    assert t1["69007"].libelle_commune == 'Lyon "Centre"'
    assert t1["69001"].libelle_departement == "Rhone"
    assert t1["69001"].libelle_circonscription == "1Ere Circonscription"
    assert t1["69001"].id_brut_miom == "690010001"
    assert t1["69001"].annee == 2024
    assert "code_canton" not in res.tables["fact_election_tour1"].columns


def test_keep_first_and_dims(etl):
    res, _ = etl
    emp = {r.codgeo: r for r in res.tables["fact_emploi_pop_active"].collect()}
    assert emp["69001"].p22_pop1564 == 253.96
    assert "6902969256" in emp
    rev = res.tables["fact_revenus"]
    assert "rapport_dinégalité" in rev.columns
    dip = res.tables["fact_diplomes"]
    assert "nombre_lves" in dip.columns
    iris = {r.codeiris: r for r in res.tables["dim_iris_lyon"].collect()}
    assert iris["690290104"].libelle == "Ferdinand Buisson Église"
    assert iris["690290104"].gid == 1029.0
    assert iris["690290201"].libelle == "Gérard Philipe-Ferdinand Buisson"
    assert iris["690290104"].type == "H"
    com = res.tables["dim_commune"].collect()
    assert all(r.libelle_commune is None for r in com)                   # Q1
    assert sorted(r.codgeo for r in com) == ["69001", "69002", "69005", "69019", "6902969256", "6912369259"]
    dep = res.tables["dim_departement"].collect()
    assert [(r.code_departement, r.libelle_departement, r.code_region) for r in dep] == [("69", "Rhone", None)]
    sec = res.tables["fact_securite"].collect()
    assert {r.annee for r in sec} == {2024}                               # Q3


def test_views(spark, etl):
    v1 = spark.table("vw_elections_communes")
    assert v1.columns == ["codgeo", "libelle_commune", "libelle_departement", "annee", "inscrits",
                          "votants", "blancs", "nuls", "exprimes", "taux_participation"]
    rows = {r.codgeo: r for r in v1.collect()}
    assert rows["69001"].taux_participation == 60.0
    assert rows["69001"].libelle_departement == "Rhone"
    v2 = spark.table("vw_indicateurs_territoires")
    assert v2.count() == 6
    assert v2.columns[-1] == "annee_1" and "annee" in v2.columns


def test_outputs_written(spark, etl):
    res, cfg = etl
    run = os.path.basename(res.run_path)
    assert latest_run(spark, cfg.output_path)["tables"] == res.run_path
    for name in ("fact_revenus", "dim_commune", "quality_report"):
        d = os.path.join(cfg.output_path, run, name)
        parts = [f for f in os.listdir(d) if f.startswith("part-")]
        assert len(parts) == 1
        with open(os.path.join(d, parts[0]), encoding="utf-8") as f:
            assert f.read(1) == "﻿"


def test_missing_source(spark, tmp_dir):
    with pytest.raises(SourceNotFoundError):
        read_delimited(spark, os.path.join(tmp_dir, "nope.csv"))


def test_corrected_quirks(spark, tmp_path_factory):
    from terroir.quirks import CORRECTED
    base = tmp_path_factory.mktemp("etl_fixed")
    data = base / "data"
    data.mkdir()
    write_inputs(str(data), securite_encoding="utf-8")
    cfg = EtlConfig(str(data), str(base / "out"), str(base / "tables"), quirks=CORRECTED)
    res = run(spark, cfg)
    t = res.tables
    com = {r.codgeo: r.libelle_commune for r in t["dim_commune"].collect()}
    assert com["69006"] == "Vénissieux"                                   # Q1 + Q10 corrected
    assert "6902969256" not in com                                        # Q6 corrected
    assert {r.annee for r in t["fact_securite"].collect()} == {2016, 2017, 2018}   # Q3
    dep = t["dim_departement"].collect()
    assert [(r.code_departement, r.code_region) for r in dep] == [("69", "84")]    # Q4
    assert {r.indicateur for r in t["fact_securite"].collect()} >= {"Homicides"}
    assert {r.unite_de_compte for r in t["fact_securite"].collect()} >= {"Véhicule"}  # Q5
    v1 = {r.codgeo: r.libelle_commune for r in spark.table("vw_elections_communes").collect()}
    assert v1["69002"] == "Saint-Germain-Au-Mont-D'Or"                    # Q2 corrected


def test_failed_run_keeps_published_tables(spark, etl, tmp_path_factory, monkeypatch):
    import terroir.plans.etl as etl_mod
    res, cfg = etl
    attach(spark, cfg.output_path)
    old_run = latest_run(spark, cfg.output_path)
    old_counts = {n: spark.table(n).count() for n in ("fact_emploi_pop_active", "vw_elections_communes")}
    data = tmp_path_factory.mktemp("etl_broken")
    write_inputs(str(data))
    real = etl_mod.write_delimited

    def failing(df, path, **kw):                 # dies after four tables were written
        if path.endswith("fact_revenus"):
            raise RuntimeError("executor lost for good")
        return real(df, path, **kw)

    def failing_commit(*_):
        raise RuntimeError("driver lost")

    monkeypatch.setattr(etl_mod, "write_delimited", failing)
    with pytest.raises(RuntimeError):
        run(spark, EtlConfig(str(data), cfg.output_path, cfg.table_path))
    monkeypatch.setattr(etl_mod, "write_delimited", real)
    monkeypatch.setattr(etl_mod, "_replace_file", failing_commit)
    with pytest.raises(RuntimeError):            # dies when everything but the commit is done
        run(spark, EtlConfig(str(data), cfg.output_path, cfg.table_path))
    assert latest_run(spark, cfg.output_path) == old_run
    other = spark.newSession()
    assert attach(other, cfg.output_path)["fact_emploi_pop_active"].count() == old_counts["fact_emploi_pop_active"]
    assert {n: spark.table(n).count() for n in old_counts} == old_counts


def test_model_from_warehouse(spark, etl):
    from terroir.plans.model import run_from_warehouse
    res = run_from_warehouse(spark.newSession(), etl[1].output_path, num_trees=3, max_depth=2, aggregate_rounds=False)
    assert run_from_warehouse(spark, num_trees=2, max_depth=2).metrics.count() == 1
    feats = [r.feature for r in res.importance.collect()]
    assert set(feats) <= {"inscrits_t1", "votants_t1", "blancs_t1", "nuls_t1", "exprimes_t1",
                          "taux_blancs_t1", "taux_nuls_t1"} and feats
    assert res.missing.count() > 0


def test_another_session_attaches(spark, etl):
    res, cfg = etl
    other = spark.newSession()
    attach(other, cfg.output_path)
    assert {t.name for t in other.catalog.listTables()} >= {*res.tables, "vw_elections_communes", "vw_indicateurs_territoires"}
    assert other.sql("SELECT count(*) FROM vw_elections_communes").first()[0] == 4
    assert len(res.tables) == 11
