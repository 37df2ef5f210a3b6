"""The example of the README, on a small model."""

import re
from pathlib import Path

README = Path(__file__).resolve().parent.parent / "README.md"
SCHEMA = """Table,Colname,IsPK,ColDataType,FKTable,FKColname
Version,VersionID,TRUE,int,NA,NA
Version,Version,FALSE,text,NA,NA
Country,CountryID,TRUE,int,NA,NA
Country,Country,FALSE,text,NA,NA
Flows,ValidFromVersion,TRUE,int,Version,VersionID
Flows,ValidToVersion,TRUE,int,Version,VersionID
Flows,Country,TRUE,int,Country,CountryID
Flows,Year,TRUE,int,NA,NA
Flows,EJ,FALSE,double precision,NA,NA
"""


def test_example(spark, tmp_path):
    (tmp_path / "model").mkdir()
    (tmp_path / "model" / "Schema.csv").write_text(SCHEMA)
    (tmp_path / "model" / "Version.csv").write_text("VersionID,Version\n1,v1\n2,v2\n3,v3\n")
    (tmp_path / "model" / "Country.csv").write_text("CountryID,Country\n1,KEN\n2,PER\n")
    rows = [(v, v, c, y, 0.1 * y + 1e-17) for v in ("v2", "v3") for c in ("KEN", "PER") for y in (1989, 1990, 1991)]
    flows = spark.createDataFrame(rows, "ValidFromVersion string, ValidToVersion string, Country string, Year int, EJ double")
    code = re.search(r"```python\n(.*?)```", README.read_text(), re.DOTALL)[1]
    code = code.replace("/data/", f"{tmp_path}/").replace('"energy"', f'"readme_{tmp_path.name}"')
    names = {"spark": spark, "flows": flows}
    exec(code, names)
    assert names["rows"].count() == 4
    found = {tuple(r) for r in names["same"].select(*flows.columns).collect()}
    assert {r[:4] for r in found} == {r[:4] for r in rows}
