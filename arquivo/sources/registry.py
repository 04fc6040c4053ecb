"""The dataset registry: which directory and file-name shape holds which dataset.

The registry is a fixed table (113 datasets, 175 periods, 13 documentation
keys, 16 auxiliary-table keys, 16 groups). It is tiny and its size does not
grow with the data, so every join against it is a broadcast join; the row
counts are asserted at import time (see ``_check``).

Values below are fixed values that must equal the archive's own layout; they
are stated as plain data in their natural order.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from arquivo.sources.local import local_table

# ---------------------------------------------------------------------------
# Federative units (27 states + BR), in the archive's order.
# ---------------------------------------------------------------------------
UF_CODES = [
    "AC", "AL", "AP", "AM", "BA", "CE", "DF", "ES", "GO", "MA", "MT", "MS", "MG", "PA",
    "PB", "PR", "PE", "PI", "RJ", "RN", "RS", "RO", "RR", "SC", "SP", "SE", "TO", "BR",
]

BASE = "/dissemin/publicos"

# ---------------------------------------------------------------------------
# File-name shapes. Each shape is anchored at the end of the
# lower-cased stem (name without ".ext"), so whatever precedes it is the
# dataset prefix. Group order: the fields listed in SHAPE_FIELDS.
# ---------------------------------------------------------------------------
_UF = "|".join(c.lower() for c in UF_CODES)
_MM = "0[1-9]|1[0-2]"
SHAPE_SUFFIX = {
    "uf_year2_month": f"({_UF})([0-9]{{2}})({_MM})",
    "uf_year2_month_sia_pa": f"({_UF})([0-9]{{2}})({_MM})(|[a-z])",
    "uf_year": f"({_UF})([0-9]{{4}})",
    "uf_year2": f"({_UF})([0-9]{{2}})",
    "year": "([0-9]{4})",
    "year2": "([0-9]{2})",
    "uf_mapas_year": f"({_UF})_mapas_([0-9]{{4}})",
    "uf_cnv": f"({_UF})_cnv",
    "any": "(.*)",
}
# Which partition field each capture group of a shape fills. "yy" is a
# two-digit year resolved by the century rule, "yyyy" a four-digit year.
SHAPE_FIELDS = {
    "uf_year2_month": ("uf", "yy", "month"),
    "uf_year2_month_sia_pa": ("uf", "yy", "month", "version"),
    "uf_year": ("uf", "yyyy"),
    "uf_year2": ("uf", "yy"),
    "year": ("yyyy",),
    "year2": ("yy",),
    "uf_mapas_year": ("uf", "yyyy"),
    "uf_cnv": ("uf",),
    "any": ("version",),
}

# Granularity of the period range shown in summaries, from the registry's
# partition list: "year" wins over "yearmonth"; anything else shows no range.
PARTITION_UF_YEARMONTH = ("uf", "yearmonth")
PARTITION_UF_YEAR = ("uf", "year")
PARTITION_YEAR = ("year",)
PARTITION_UF = ("uf",)
PARTITION_VERSION = ("version",)


@dataclass(frozen=True)
class Period:
    dir: str
    prefix: str
    shape: str
    extension: str
    preliminary: bool = False


@dataclass(frozen=True)
class Dataset:
    key: str
    name: str
    group: str
    partition: tuple[str, ...]
    periods: tuple[Period, ...]


def _p(dir_: str, prefix: str, shape: str, ext: str = "dbc", prelim: bool = False) -> Period:
    return Period(dir_, prefix, shape, ext, prelim)


_YM = PARTITION_UF_YEARMONTH
_UY = PARTITION_UF_YEAR
_Y = PARTITION_YEAR

# ---------------------------------------------------------------------------
# Datasets other than SINAN, in registry order.
# (key, display name, group, partition fields, periods)
# ---------------------------------------------------------------------------
_SIH_OLD = BASE + "/SIHSUS/199201_200712/Dados"
_SIH_NEW = BASE + "/SIHSUS/200801_/Dados"
_SIA_NEW = BASE + "/SIASUS/200801_/Dados"
_CNES = BASE + "/CNES/200508_/Dados/"

_MAIN = [
    ("sih-rd", "RD - AIH Reduzida", "sih", _YM,
     [_p(_SIH_OLD, "RD", "uf_year2_month"), _p(_SIH_NEW, "RD", "uf_year2_month")]),
    ("sih-rj", "RJ - AIH Rejeitadas", "sih", _YM, [_p(_SIH_NEW, "RJ", "uf_year2_month")]),
    ("sih-sp", "SP - Serviços Profissionais", "sih", _YM,
     [_p(_SIH_OLD, "SP", "uf_year2_month"), _p(_SIH_NEW, "SP", "uf_year2_month")]),
    ("sih-er", "ER - AIH Rejeitadas com código de erro", "sih", _YM,
     [_p(_SIH_NEW, "ER", "uf_year2_month")]),
    ("sinasc-dn", "Declarações de nascidos vivos", "sinasc", _UY,
     [_p(BASE + "/SINASC/1994_1995/Dados/DNRES", "DNR", "uf_year"),
      _p(BASE + "/SINASC/1996_/Dados/DNRES", "DN", "uf_year"),
      _p(BASE + "/SINASC/PRELIM/DNRES", "DN", "uf_year", prelim=True)]),
    ("sinasc-dnex", "Declarações de nascidos vivos no exterior", "sinasc", _Y,
     [_p(BASE + "/SINASC/1996_/Dados/DNRES", "DNEX", "year")]),
    ("sim-do-cid09", "Declarações de Óbito CID-9", "sim", _UY,
     [_p(BASE + "/SIM/CID9/DORES", "DOR", "uf_year2")]),
    ("sim-do-cid10", "Declarações de Óbito CID-10", "sim", _UY,
     [_p(BASE + "/SIM/CID10/DORES", "DO", "uf_year"),
      _p(BASE + "/SIM/PRELIM/DORES", "DO", "uf_year", prelim=True)]),
    ("sim-doext-cid09", "Declarações de Óbito Externas CID-9", "sim", _Y,
     [_p(BASE + "/SIM/CID9/DOFET", "DOEXT", "year2")]),
    ("sim-doext-cid10", "Declarações de Óbito Externas CID-10", "sim", _Y,
     [_p(BASE + "/SIM/CID10/DOFET", "DOEXT", "year2")]),
    ("sim-dofet-cid09", "Declarações de Óbito Fetais CID-9", "sim", _Y,
     [_p(BASE + "/SIM/CID9/DOFET", "DOFET", "year2")]),
    ("sim-dofet-cid10", "Declarações de Óbito Fetais CID-10", "sim", _Y,
     [_p(BASE + "/SIM/CID10/DOFET", "DOFET", "year2")]),
    ("sim-doinf-cid09", "Declarações de Óbito Infantis CID-9", "sim", _Y,
     [_p(BASE + "/SIM/CID9/DOFET", "DOINF", "year2")]),
    ("sim-doinf-cid10", "Declarações de Óbito Infantis CID-10", "sim", _Y,
     [_p(BASE + "/SIM/CID10/DOFET", "DOINF", "year2")]),
    ("sim-domat-cid10", "Declarações de Óbitos Maternos CID-10", "sim", _Y,
     [_p(BASE + "/SIM/CID10/DOFET", "DOMAT", "year2")]),
    ("sim-dorext-cid10", "Mortalidade de Residentes no Exterior CID-10", "sim", _Y,
     [_p(BASE + "/SIM/CID10/DOFET", "DOREXT", "year2")]),
    ("cnes-dc", "Dados Complementares", "cnes", _YM, [_p(_CNES + "DC", "DC", "uf_year2_month")]),
    ("cnes-ee", "Estabelecimento de Ensino", "cnes", _YM, [_p(_CNES + "EE", "EE", "uf_year2_month")]),
    ("cnes-ef", "Estabelecimento Filantrópico", "cnes", _YM, [_p(_CNES + "EF", "EF", "uf_year2_month")]),
    ("cnes-ep", "Equipes", "cnes", _YM, [_p(_CNES + "EP", "EP", "uf_year2_month")]),
    ("cnes-eq", "Equipamentos", "cnes", _YM, [_p(_CNES + "EQ", "EQ", "uf_year2_month")]),
    ("cnes-gm", "Gestão e Metas", "cnes", _YM, [_p(_CNES + "GM", "GM", "uf_year2_month")]),
    ("cnes-hb", "Habilitação", "cnes", _YM, [_p(_CNES + "HB", "HB", "uf_year2_month")]),
    ("cnes-in", "Incentivos", "cnes", _YM, [_p(_CNES + "IN", "IN", "uf_year2_month")]),
    ("cnes-lt", "Leitos", "cnes", _YM, [_p(_CNES + "LT", "LT", "uf_year2_month")]),
    ("cnes-pf", "Profissional", "cnes", _YM, [_p(_CNES + "PF", "PF", "uf_year2_month")]),
    ("cnes-rc", "Regra Contratual", "cnes", _YM, [_p(_CNES + "RC", "RC", "uf_year2_month")]),
    ("cnes-sr", "Serviço Especializado", "cnes", _YM, [_p(_CNES + "SR", "SR", "uf_year2_month")]),
    ("cnes-st", "Estabelecimentos", "cnes", _YM, [_p(_CNES + "ST", "ST", "uf_year2_month")]),
    ("sia-ab", "APAC de Acompanhamento a Cirurgia Bariátrica", "sia", _YM,
     [_p(_SIA_NEW, "AB", "uf_year2_month")]),
    ("sia-abo", "APAC Acompanhamento Pós Cirurgia Bariátrica", "sia", _YM,
     [_p(_SIA_NEW, "ABO", "uf_year2_month")]),
    ("sia-acf", "APAC Confeção de Fístula Arteriovenosa", "sia", _YM,
     [_p(_SIA_NEW, "ACF", "uf_year2_month")]),
    ("sia-ad", "APAC de Laudos Diversos", "sia", _YM, [_p(_SIA_NEW, "AD", "uf_year2_month")]),
    ("sia-am", "APAC de Medicamentos", "sia", _YM, [_p(_SIA_NEW, "AM", "uf_year2_month")]),
    ("sia-an", "APAC de Nefrologia", "sia", _YM, [_p(_SIA_NEW, "AN", "uf_year2_month")]),
    ("sia-aq", "APAC de Quimioterapia", "sia", _YM, [_p(_SIA_NEW, "AQ", "uf_year2_month")]),
    ("sia-ar", "APAC de Radioterapia", "sia", _YM, [_p(_SIA_NEW, "AR", "uf_year2_month")]),
    ("sia-atd", "APAC de Tratamento Dialítico", "sia", _YM, [_p(_SIA_NEW, "ATD", "uf_year2_month")]),
    ("sia-pa", "Produção Ambulatorial", "sia", _YM,
     [_p(BASE + "/SIASUS/199407_200712/Dados", "PA", "uf_year2_month"),
      _p(_SIA_NEW, "PA", "uf_year2_month_sia_pa")]),
    ("sia-ps", "Psicossocial", "sia", _YM, [_p(_SIA_NEW, "PS", "uf_year2_month")]),
    ("sia-sad", "Atenção Domiciliar", "sia", _YM, [_p(_SIA_NEW, "SAD", "uf_year2_month")]),
    ("cih-cr", "Comunicação de Internação Hospitalar", "cih", _YM,
     [_p(BASE + "/CIH/200801_201012/Dados", "CR", "uf_year2_month")]),
    ("ciha", "Sistema de Comunicação de Informação Hospitalar e Ambulatorial", "ciha", _YM,
     [_p(BASE + "/CIHA/201101_/Dados", "CIHA", "uf_year2_month")]),
    ("resp", "Notificações de casos suspeitos de SCZ", "resp", _UY,
     [_p(BASE + "/RESP/DADOS", "RESP", "uf_year2")]),
    ("sisprenatal-pn", "Pré-Natal", "sisprenatal", _YM,
     [_p(BASE + "/SISPRENATAL/201201_/Dados", "PN", "uf_year2_month")]),
    ("base-populacional-ibge-pop", "POP - Censo e Estimativas", "base-populacional-ibge", _UY,
     [_p(BASE + "/IBGE/POP", "POP", "uf_year2", "zip")]),
    ("base-populacional-ibge-pops", "POPS - Estimativas por Sexo e Idade", "base-populacional-ibge", _UY,
     [_p(BASE + "/IBGE/POPSVS", "POPS", "uf_year2", "zip")]),
    ("base-populacional-ibge-popt", "POPT - Estimativas TCU", "base-populacional-ibge", _UY,
     [_p(BASE + "/IBGE/POPTCU", "POPT", "uf_year2", "zip")]),
    ("base-territorial-mapas", "Base Territorial - Mapas", "base-territorial", _UY,
     [_p("/territorio/mapas", "", "uf_mapas_year", "zip")]),
    ("base-territorial", "Base Territorial", "base-territorial", PARTITION_VERSION,
     [_p("/territorio/tabelas", "", "any", "zip")]),
    ("base-territorial-conversao", "Base Territorial - Conversão", "base-territorial", PARTITION_UF,
     [_p("/territorio/conversoes", "", "uf_cnv", "zip")]),
    ("pce", "Programa de Controle da Esquistossomose", "pce", _UY,
     [_p(BASE + "/PCE/DADOS", "PCE", "uf_year2")]),
    ("po", "Painel de Oncologia", "po", _UY, [_p(BASE + "/PAINEL_ONCOLOGIA/DADOS", "PO", "uf_year")]),
    ("siscolo-cc", "Citopatológico de Colo de Útero", "siscolo", _YM,
     [_p(BASE + "/SISCAN/SISCOLO4/Dados", "CC", "uf_year2_month")]),
    ("siscolo-hc", "Histopatológico de Colo de Útero", "siscolo", _YM,
     [_p(BASE + "/SISCAN/SISCOLO4/Dados", "HC", "uf_year2_month")]),
    ("sismama-cm", "Citopatológico de Mama", "sismama", _YM,
     [_p(BASE + "/SISCAN/SISMAMA/Dados", "CM", "uf_year2_month")]),
    ("sismama-hm", "Histopatológico de Mama", "sismama", _YM,
     [_p(BASE + "/SISCAN/SISMAMA/Dados", "HM", "uf_year2_month")]),
]

# ---------------------------------------------------------------------------
# SINAN notifiable diseases (code, display name), registry order.
# Every SINAN dataset follows one rule: key "sinan-<code>", group "sinan",
# partition uf+year, the upper-cased code as prefix, shape uf_year2, one final
# and one preliminary period.
# ---------------------------------------------------------------------------
SINAN_CODES = [
    ("acbi", "Acidente de trabalho com material biológico"),
    ("acgr", "Acidente de trabalho"),
    ("anim", "Acidente por Animais Peçonhentos"),
    ("antr", "Atendimento Antirrábico"),
    ("botu", "Botulismo"),
    ("canc", "Câncer relacionado ao trabalho"),
    ("chag", "Doença de Chagas Aguda"),
    ("chik", "Febre de Chikungunya"),
    ("cole", "Cólera"),
    ("coqu", "Coqueluche"),
    ("deng", "Dengue"),
    ("derm", "Dermatoses ocupacionais"),
    ("dift", "Difteria"),
    ("esqu", "Esquistossomose"),
    ("fmac", "Febre Maculosa"),
    ("ftif", "Febre Tifoide"),
    ("hans", "Hanseníase"),
    ("hant", "Hantavirose"),
    ("hepa", "Hepatites Virais"),
    ("iexo", "Intoxicação Exógena"),
    ("leiv", "Leishmaniose Visceral"),
    ("lept", "Leptospirose"),
    ("lerd", "LER/Dort"),
    ("ltan", "Leishmaniose Tegumentar Americana"),
    ("mala", "Malária"),
    ("meni", "Meningite"),
    ("ment", "Transtornos mentais relacionados ao trabalho"),
    ("pair", "Perda auditiva por ruído relacionado ao trabalho"),
    ("pest", "Peste"),
    ("pfan", "Paralisia Flácida Aguda"),
    ("pneu", "Pneumoconioses relacionadas ao trabalho"),
    ("raiv", "Raiva"),
    ("sifa", "Sífilis Adquirida"),
    ("sifc", "Sífilis Congênita"),
    ("sifg", "Sífilis em Gestante"),
    ("teta", "Tétano Acidental"),
    ("tetn", "Tétano Neonatal"),
    ("tube", "Tuberculose"),
    ("viol", "Violência doméstica, sexual e/ou outras violências"),
    ("zika", "Zika Vírus"),
    ("exan", "Doenças exantemáticas"),
    ("ntra", "Notificação de Tracoma"),
    ("sdta", "Surto Doenças Transmitidas por Alimentos"),
    ("src", "Síndrome da Rubéola Congênita"),
    ("toxc", "Toxoplasmose Congênita"),
    ("toxg", "Toxoplasmose Gestacional"),
    ("trac", "Inquérito de Tracoma"),
    ("varc", "Varicela"),
    ("aida", "AIDS em adultos"),
    ("aidc", "AIDS em crianças"),
    ("espo", "Esporotricose (Epizootia)"),
    ("hiva", "HIV em adultos"),
    ("hivc", "HIV em crianças"),
    ("hive", "HIV em crianças expostas"),
    ("hivg", "HIV em gestante"),
    ("rota", "Rotavírus"),
]

# ---------------------------------------------------------------------------
# Documentation and auxiliary-table directories per key. Keys
# are group names (plus "cmd", which is neither a group nor a dataset).
# ---------------------------------------------------------------------------
DOCS = {
    "base-populacional-ibge": [BASE + "/IBGE/DOC"],
    "base-territorial": ["/territorio/doc"],
    "cmd": [BASE + "/CMD/201701_/doc"],
    "ciha": [BASE + "/CIHA/201101_/Doc"],
    "cnes": [BASE + "/CNES/200508_/doc"],
    "pce": [BASE + "/PCE/DOCS/"],
    "po": [BASE + "/PAINEL_ONCOLOGIA/DOC"],
    "resp": [BASE + "/RESP/DOCS"],
    "sia": [BASE + "/SIASUS/200801_/Doc"],
    "sih": [BASE + "/SIHSUS/200801_/Doc"],
    "sim": [BASE + "/SIM/CID9/DOCS", BASE + "/SIM/CID10/DOCS"],
    "sinan": [BASE + "/SINAN/DOCS"],
    "sinasc": [BASE + "/SINASC/ANT/DOCS", BASE + "/SINASC/NOV/DOCS"],
}

AUXILIARY = {
    "base-populacional-ibge": [BASE + "/IBGE/Auxiliar"],
    "cih": [BASE + "/CIH/200801_201012/Auxiliar"],
    "ciha": [BASE + "/CIHA/201101_/Auxiliar"],
    "cmd": [BASE + "/CMD/201701_/Auxiliar"],
    "cnes": [BASE + "/CNES/200508_/Auxiliar"],
    "pce": [BASE + "/PCE/AUXILIAR"],
    "po": [BASE + "/PAINEL_ONCOLOGIA/AUXILIAR"],
    "resp": [BASE + "/RESP/AUXILIAR"],
    "sia": [BASE + "/SIASUS/200801_/Auxiliar"],
    "sih": [BASE + "/SIHSUS/200801_/Auxiliar"],
    "sim": [BASE + "/SIM/CID9/TAB", BASE + "/SIM/CID10/TAB"],
    "sinan": [BASE + "/SINAN/AUXILIAR"],
    "sinasc": [BASE + "/SINASC/1994_1995/Auxiliar", BASE + "/SINASC/1996_/Auxiliar"],
    "siscolo": [BASE + "/SISCAN/SISCOLO4/Auxiliar"],
    "sismama": [BASE + "/SISCAN/SISMAMA/Auxiliar"],
    "sisprenatal": [BASE + "/SISPRENATAL/201201_/Auxiliar"],
}

GROUPS = {
    "base-populacional-ibge": "Base Populacional - IBGE",
    "base-territorial": "Base Territorial",
    "cih": "CIH: Sistema de Comunicação de Informação Hospitalar",
    "ciha": "CIHA: Sistema de Comunicação de Informação Hospitalar e Ambulatorial",
    "cnes": "CNES: Cadastro Nacional de Estabelecimentos de Saúde",
    "pce": "PCE: Programa de Controle da Esquistossomose",
    "po": "PO: Painel de Oncologia",
    "resp": "RESP: Notificações de casos suspeitos de SCZ",
    "sia": "SIA: Sistema de Informações Ambulatoriais",
    "sih": "SIH: Sistema de Informação Hospitalar",
    "sim": "SIM: Sistema de Informação de Mortalidade",
    "sinan": "SINAN: Sistema de Informação de Agravos de Notificação",
    "sinasc": "SINASC: Sistema de Informação de Nascidos Vivos",
    "siscolo": "SISCOLO: Sistema de Informações de Cânceres de Colo de Útero",
    "sismama": "SISMAMA: Sistema de Informações de Cânceres de Mama",
    "sisprenatal": (
        "SISPRENATAL: Sistema de Monitoramento e Avaliação do"
        " Pré-Natal, Parto, Puepério e Criança"
    ),
}


def _sinan_dataset(code: str, name: str) -> Dataset:
    prefix = code.upper()
    return Dataset(
        key=f"sinan-{code}",
        name=name,
        group="sinan",
        partition=PARTITION_UF_YEAR,
        periods=(
            _p(BASE + "/SINAN/DADOS/FINAIS", prefix, "uf_year2"),
            _p(BASE + "/SINAN/DADOS/PRELIM", prefix, "uf_year2", prelim=True),
        ),
    )


def _build() -> dict[str, Dataset]:
    out: dict[str, Dataset] = {}
    for key, name, group, partition, periods in _MAIN:
        out[key] = Dataset(key, name, group, tuple(partition), tuple(periods))
    for code, name in SINAN_CODES:
        ds = _sinan_dataset(code, name)
        out[ds.key] = ds
    return out


DATASETS: dict[str, Dataset] = _build()


def _check() -> None:
    periods = [p for d in DATASETS.values() for p in d.periods]
    assert len(DATASETS) == 113, len(DATASETS)
    assert len(periods) == 175, len(periods)
    assert sum(p.preliminary for p in periods) == 58
    for p in periods:
        # An unknown shape is a registry error, caught at build time.
        if p.shape not in SHAPE_SUFFIX:
            raise ValueError(f"Pattern not found: {p.shape}")
        # The shape join (classify) relies on literal prefixes and extensions.
        assert p.prefix.isalnum() or p.prefix == "", p.prefix
        assert p.extension.isalnum(), p.extension
    assert {d.group for d in DATASETS.values()} == set(GROUPS)


_check()


def granularity(partition: tuple[str, ...]) -> str:
    """Period-range granularity used by the summary: year, yearmonth or none."""
    if "year" in partition:
        return "year"
    if "yearmonth" in partition:
        return "yearmonth"
    return "none"


def period_regex(p: Period) -> str:
    """The full per-period regex on the lower-cased file name."""
    return f"^{p.prefix}{SHAPE_SUFFIX[p.shape]}\\.{p.extension}$".lower()


def period_rows() -> list[tuple]:
    rows = []
    for d in DATASETS.values():
        for i, p in enumerate(d.periods):
            rows.append(
                (
                    d.key, d.name, d.group, list(d.partition), granularity(d.partition), i,
                    p.dir, p.prefix.lower(), p.shape, p.extension.lower(), p.preliminary,
                    period_regex(p),
                )
            )
    return rows


PERIOD_SCHEMA = T.StructType(
    [
        T.StructField("dataset", T.StringType(), False),
        T.StructField("dataset_name", T.StringType(), False),
        T.StructField("group", T.StringType(), False),
        T.StructField("partition_fields", T.ArrayType(T.StringType(), False), False),
        T.StructField("granularity", T.StringType(), False),
        T.StructField("period_index", T.IntegerType(), False),
        T.StructField("period_dir", T.StringType(), False),
        T.StructField("prefix", T.StringType(), False),
        T.StructField("shape", T.StringType(), False),
        T.StructField("extension", T.StringType(), False),
        T.StructField("preliminary", T.BooleanType(), False),
        T.StructField("pattern", T.StringType(), False),
    ]
)


_FRAMES: dict[tuple[int, str], DataFrame] = {}


def _memo(spark: SparkSession, key: str, build) -> DataFrame:
    """Registry frames are fixed: build each once per session (parsing the
    VALUES text costs a few hundred milliseconds of planning)."""
    k = (id(spark), key)
    df = _FRAMES.get(k)
    if df is None or df.sparkSession is not spark:
        df = build()
        _FRAMES[k] = df
    return df


def _ddl(schema: T.StructType) -> list[tuple[str, str]]:
    return [(f.name, f.dataType.simpleString()) for f in schema.fields]


def registry(spark: SparkSession) -> DataFrame:
    """One row per (dataset, period); 175 rows, a local relation."""
    return _memo(spark, "periods", lambda: local_table(spark, period_rows(), _ddl(PERIOD_SCHEMA)))


def datasets(spark: SparkSession) -> DataFrame:
    """One row per dataset (113): key, name, group, partition fields, granularity."""
    rows = [
        (d.key, d.name, d.group, list(d.partition), granularity(d.partition))
        for d in DATASETS.values()
    ]
    schema = [("dataset", "string"), ("dataset_name", "string"), ("group", "string"),
              ("partition_fields", "array<string>"), ("granularity", "string")]
    return _memo(spark, "datasets", lambda: local_table(spark, rows, schema))


def support_registry(spark: SparkSession, kind: str | None = None) -> DataFrame:
    """S3: (type, key, support_dir) for documentation ('doc') and auxiliary ('aux')."""
    rows = [("doc", k, d) for k, dirs in DOCS.items() for d in dirs]
    rows += [("aux", k, d) for k, dirs in AUXILIARY.items() for d in dirs]
    df = _memo(spark, "support",
               lambda: local_table(spark, rows, [("type", "string"), ("key", "string"), ("support_dir", "string")]))
    if kind is not None:
        df = df.filter(F.col("type") == kind)
    return df


def groups(spark: SparkSession) -> DataFrame:
    """Group key and display name (16 rows)."""
    return _memo(spark, "groups",
                 lambda: local_table(spark, list(GROUPS.items()), [("group", "string"), ("group_name", "string")]))


def uf_codes(spark: SparkSession) -> DataFrame:
    """The 28 UF codes, upper case as published and lower case as in names."""
    return local_table(spark, [(c, c.lower()) for c in UF_CODES], [("uf_code", "string"), ("uf", "string")])


def period_dirs() -> list[str]:
    """Distinct directories of all periods (a fixed, bounded list)."""
    return sorted({p.dir for d in DATASETS.values() for p in d.periods})


def support_dirs() -> list[str]:
    return sorted({d for dirs in list(DOCS.values()) + list(AUXILIARY.values()) for d in dirs})
