"""The HTML briefing and the map page: aggregated by Spark, rendered here from a few rows."""

from __future__ import annotations

import html
import json
from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from furrow.functions import grading
from furrow.operators import rollup

STYLE = """
body{font:15px/1.6 "Noto Sans CJK SC","PingFang SC","Microsoft YaHei",sans-serif;margin:0;background:#f4f6f5;color:#22302a}
main{max-width:1080px;margin:0 auto;padding:24px}h1{font-size:26px;margin:8px 0}h2{font-size:18px;border-left:4px solid #3d7a55;padding-left:10px}
section{background:#fff;border-radius:8px;padding:16px 20px;margin:16px 0;box-shadow:0 1px 3px rgba(0,0,0,.08)}
.cards{display:grid;grid-template-columns:repeat(4,1fr);gap:12px}.card{background:#f7faf8;border-radius:6px;padding:12px}.card b{font-size:22px;display:block}
table{border-collapse:collapse;width:100%}th,td{border-bottom:1px solid #e3e8e5;padding:6px 8px;text-align:left}th{background:#eef3f0}
.badge-opt{color:#1d6b3a}.badge-good{color:#2c5f9e}.badge-warn{color:#a86a00}.badge-danger{color:#b3261e}
.bar{background:#e3e8e5;height:8px;border-radius:4px}.bar i{background:#3d7a55;height:8px;border-radius:4px;display:block}
"""


def table(columns: Iterable[str], rows: Iterable[Iterable]) -> str:
    cell = lambda x: x if isinstance(x, Raw) else html.escape("" if x is None else str(x))
    return "<table><tr>" + "".join(f"<th>{html.escape(c)}</th>" for c in columns) + "</tr>" + "".join("<tr>" + "".join(f"<td>{cell(v)}</td>" for v in r) + "</tr>" for r in rows) + "</table>"


class Raw(str):
    """Text that is HTML already."""


def badge(kind: str, text: str) -> Raw:
    return Raw(f'<span class="{kind}">{html.escape(text)}</span>')


def kpi_cards(acreage: DataFrame, parcels: DataFrame, choice: int | None = None) -> DataFrame:
    """One row: the focus crop's naive, calibrated and parcel areas in fitting units, bias, accuracy and CV."""
    focus = rollup.focus_crop(acreage, choice)
    own = parcels.agg(F.coalesce(F.sum("area_mu"), F.lit(0.0)).alias("parcel_mu"), F.count("*").alias("parcels"))
    x = focus.crossJoin(F.broadcast(own))
    unit = lambda c: grading.kpi(F.col(c), F.col("calibrated_mu"))["value"]
    return x.select(
        "code", unit("naive_mu").alias("naive"), unit("calibrated_mu").alias("calibrated"), unit("parcel_mu").alias("in_parcels"), grading.kpi(F.col("calibrated_mu"), F.col("calibrated_mu"))["unit"].alias("unit"),
        "se_mu", "cv_pct", "ci_low_mu", "ci_high_mu", "bias_pct", "parcels", F.round(F.least(F.lit(100.0), F.col("parcel_mu") / F.greatest("calibrated_mu", F.lit(1.0)) * 100), 1).alias("parcel_share_pct"),
    )


def briefing(acreage: DataFrame, parcels: DataFrame, compliance: DataFrame | None = None, matrix: DataFrame | None = None, plan: DataFrame | None = None, charts: list[str] | None = None, title: str = "农情遥感监测简报", choice: int | None = None) -> str:
    """A page of six sections: headline figures, area statistics with the error matrix, charts, provinces, top parcels, rotation and sampling."""
    k = kpi_cards(acreage, parcels, choice).first()
    parts = [f"<h1>{html.escape(title)}</h1>"]
    if k:
        cards = [("像元直数面积", f"{k['naive']} {k['unit']}"), ("校准无偏面积", f"{k['calibrated']} {k['unit']}"), (f"地块面积（{k['parcels']} 块，占 {k['parcel_share_pct']}%）", f"{k['in_parcels']} {k['unit']}"), ("偏差", f"{k['bias_pct']:+.1f}%")]
        parts.append('<section><div class="cards">' + "".join(f'<div class="card">{html.escape(a)}<b>{html.escape(b)}</b></div>' for a, b in cards) + "</div></section>")
    graded = acreage.withColumn("badge", grading.cv_grade(F.col("cv_pct"))).withColumn("words", grading.cv_grade(F.col("cv_pct"), grading.CV_TEXTS))
    named = "name" if "name" in acreage.columns else "code"
    rows = [(r[named], r["naive_mu"], r["calibrated_mu"], f"±{r['se_mu']}", badge(r["badge"], f"{r['cv_pct']}%"), f"{r['ci_low_mu']} ~ {r['ci_high_mu']}", f"{r['bias_mu']:+} ({r['bias_pct']:+}%)", r["words"]) for r in graded.orderBy("code").collect()]  # a row a class
    parts.append("<section><h2>一、面积无偏推断</h2>" + table(["作物", "直数(亩)", "校准(亩)", "标准误", "CV", "95% 区间", "偏差", "评定"], rows))
    parts.append((table(matrix.columns, [list(r) for r in matrix.orderBy("map_class").collect()]) if matrix is not None else "") + "</section>")
    parts.append("<section><h2>二、图件</h2>" + "".join(f'<p><img src="{html.escape(c)}" style="max-width:100%"></p>' for c in charts or []) + "</section>")
    provinces = [(r["province"], r["parcels"], r["area_mu"], r["area_ha"], Raw(f'<div class="bar"><i style="width:{r["bar_pct"]}%"></i></div>{r["share_pct"]}%')) for r in rollup.province_rollup(parcels, report=True).limit(60).collect()]
    parts.append("<section><h2>三、分省集聚度</h2>" + table(["省份", "地块", "面积(亩)", "面积(公顷)", "占比"], provinces) + "</section>")
    top = rollup.top_parcels(parcels).withColumn("badge", grading.suitability_badge(F.col("machinery_suitability")))
    best = [(r["parcel_id"], r["crop_name"], r["area_mu"], r["province"], r["agri_zone"], badge(r["badge"], r["machinery_suitability"])) for r in top.collect()]
    parts.append("<section><h2>四、主力地块前十</h2>" + table(["编号", "作物", "面积(亩)", "省份", "农区", "适机性"], best) + "</section>")
    if compliance is not None:
        seen = [(badge(r["badge"], r["kind"]), r["meaning"], r["mu"], r["advice"]) for r in compliance.withColumn("badge", grading.compliance_badge(F.col("kind"))).collect()]
        parts.append("<section><h2>五、轮作合规</h2>" + table(["监测类型", "业务定义", "面积(亩)", "建议"], seen) + "</section>")
    if plan is not None:
        parts.append("<section><h2>六、抽样设计</h2>" + table(plan.columns, [list(r) for r in plan.orderBy("code").collect()]) + "</section>")
    return f'<!doctype html><html lang="zh"><head><meta charset="utf-8"><title>{html.escape(title)}</title><style>{STYLE}</style></head><body><main>{"".join(parts)}</main></body></html>'


#: The page's script: draws rings on a canvas-free SVG, filters by crop and province, and searches.
SCRIPT = """
const P=DATA.features, q=(s)=>document.querySelector(s);
const xs=P.flatMap(f=>f.geometry.coordinates[0].map(p=>p[0])), ys=P.flatMap(f=>f.geometry.coordinates[0].map(p=>p[1]));
const lo=(a)=>a.reduce((m,v)=>Math.min(m,v),Infinity), hi=(a)=>a.reduce((m,v)=>Math.max(m,v),-Infinity);
const x0=lo(xs),x1=hi(xs),y0=lo(ys),y1=hi(ys),k=1000/Math.max(x1-x0,y1-y0,1e-9);
function shown(f){const c=[...document.querySelectorAll('.crop:checked')].map(e=>+e.value),v=q('#prov').value;return c.includes(f.properties.crop_code)&&(v==='ALL'||v===f.properties.province)}
function draw(mark){const s=P.filter(shown);q('#map').innerHTML=s.map(f=>`<polygon points="${f.geometry.coordinates[0].map(p=>((p[0]-x0)*k)+','+((y1-p[1])*k)).join(' ')}" fill="${COLOURS[f.properties.crop_code]||'#888'}" stroke="${f===mark?'#000':'#fff'}" stroke-width="${f===mark?3:.5}"><title>${f.properties.parcel_id} ${f.properties.crop_name} ${f.properties.area_mu} 亩</title></polygon>`).join('');q('#n').textContent=s.length}
function find(){const t=q('#find').value.trim().toLowerCase();draw(t?P.find(f=>{const p=f.properties;return p.parcel_id.toLowerCase()===t||p.crop_name.toLowerCase().includes(t)||(p.province||'').toLowerCase().includes(t)}):null)}
document.querySelectorAll('.crop,#prov').forEach(e=>e.onchange=()=>draw());q('#find').oninput=find;draw();
"""


def map_page(features: DataFrame, parcels: DataFrame, title: str = "地块一张图") -> str:
    """One page with the exported parcels (bounded by max_export_parcels), key figures, filters, search and the top ten."""
    k = rollup.map_kpis(parcels).first()
    crops = rollup.crop_summary(parcels).orderBy("crop_code").collect()
    body = ",\n".join(r["value"] for r in features.orderBy("parcel_no").select(F.to_json("feature").alias("value")).collect())
    names = {r["crop_code"]: r["crop_name"] for r in parcels.groupBy("crop_code").agg(F.first("crop_name").alias("crop_name")).collect()}
    colours = {r["crop_code"]: grading.PALETTE[r["crop_code"] % len(grading.PALETTE)] for r in crops}
    boxes = "".join(f'<label style="margin-right:10px"><input type="checkbox" class="crop" value="{r["crop_code"]}" checked> {html.escape(str(names[r["crop_code"]]))} ({r["parcels"]} / {r["area_mu"]} 亩)</label>' for r in crops)
    options = "".join(f"<option>{html.escape(p)}</option>" for p in (k["province_list"] or "").split(",") if p)
    top = table(["编号", "作物", "面积(亩)", "省份"], [(r["parcel_id"], r["crop_name"], r["area_mu"], r["province"]) for r in rollup.top_parcels(parcels).collect()])
    head = f'<p>{k["parcels"]} 块 · {k["area_mu"]} 亩 · {k["area_ha"]} 公顷 · 适机率 {k["machinery_pct"]}% · {k["provinces"]} 省 · 中心 {k["center_lon"]}, {k["center_lat"]}</p>'
    controls = f'<p>{boxes}<select id="prov"><option value="ALL">全部省份</option>{options}</select> <input id="find" placeholder="编号 / 作物 / 省份"> 显示 <b id="n"></b> 块</p>'
    data = '{"type":"FeatureCollection","features":[' + body.replace("</", "<\\/") + "]}"
    return f'<!doctype html><html lang="zh"><head><meta charset="utf-8"><title>{html.escape(title)}</title><style>{STYLE}</style></head><body><main><h1>{html.escape(title)}</h1><section>{head}{controls}<svg id="map" viewBox="0 0 1000 1000" style="width:100%;background:#eef3f0"></svg></section><section>{top}</section></main><script>const DATA={data},COLOURS={json.dumps(colours)};{SCRIPT}</script></body></html>'


def chart_phenology(series: DataFrame) -> DataFrame:
    """crop, day, mean value: the curves of a phenology chart."""
    return series.select("crop_name", F.explode(F.arrays_zip("days", "values")).alias("x")).groupBy("crop_name", F.col("x.days").alias("day")).agg(F.round(F.avg("x.values"), 4).alias("value"))


def chart_bars(acreage: DataFrame) -> DataFrame:
    """Naive and calibrated areas with error bars."""
    return acreage.select("code", "naive_mu", "calibrated_mu", F.round(F.col("calibrated_mu") - F.col("ci_low_mu"), 1).alias("err_low"), F.round(F.col("ci_high_mu") - F.col("calibrated_mu"), 1).alias("err_high"))


def chart_svg_bars(acreage: DataFrame) -> str:
    """The chart of naive and calibrated areas as SVG."""
    rows = chart_bars(acreage).orderBy("code").collect()
    top = max([1.0, *(max(r["naive_mu"], r["calibrated_mu"] + r["err_high"]) for r in rows)])
    y = lambda v: 260 - 230 * v / top
    out = []
    for i, r in enumerate(rows):
        x = 60 + 110 * i
        out.append(f'<rect x="{x}" y="{y(r["naive_mu"]):.1f}" width="34" height="{260 - y(r["naive_mu"]):.1f}" fill="#a9b8b0"/><rect x="{x + 38}" y="{y(r["calibrated_mu"]):.1f}" width="34" height="{260 - y(r["calibrated_mu"]):.1f}" fill="#3d7a55"/>')
        out.append(f'<line x1="{x + 55}" x2="{x + 55}" y1="{y(r["calibrated_mu"] - r["err_low"]):.1f}" y2="{y(r["calibrated_mu"] + r["err_high"]):.1f}" stroke="#22302a"/><text x="{x + 36}" y="278" text-anchor="middle" font-size="12">{r["code"]}</text>')
    return f'<svg xmlns="http://www.w3.org/2000/svg" viewBox="0 0 {120 + 110 * len(rows)} 290">{"".join(out)}</svg>'


def chart_svg_classes(pixels: DataFrame, step: int = 1, outline: str | None = None) -> str:
    """A class map, or its parcel outlines, as SVG from a downsampled scene (at most 1200 pixels a side)."""
    rows = pixels.collect()
    h, w = (max([0, *(r[x] for r in rows)]) // step + 1 for x in ("r", "c"))
    colour = lambda r: "#1a1a1a" if outline and r[outline] else grading.PALETTE[r["code"] % len(grading.PALETTE)]
    body = "".join(f'<rect x="{r["c"] // step}" y="{r["r"] // step}" width="1" height="1" fill="{colour(r)}"/>' for r in rows)
    return f'<svg xmlns="http://www.w3.org/2000/svg" viewBox="0 0 {w} {h}" shape-rendering="crispEdges">{body}</svg>'
