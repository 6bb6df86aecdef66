"""Farming zones by longitude and latitude, and what machines a parcel suits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Rules in order, the first that holds wins. West, east, south, north; a trailing o means that end is open.
# A sixth entry (axis, limit) sends places below the limit to the first zone and others to the second.
RULES = [
    ("73", "96.5", "34", "49", "新疆维吾尔自治区", ["南疆绿洲冬春麦区", "北疆绿洲灌溉麦区"], ("lat", 40.0)),
    ("104", "107.8", "35", "39.5", "宁夏回族自治区", ["宁夏平原引黄灌区优质小麦带"], None),
    ("106", "113", "39.5o", "42.5", "内蒙古自治区", ["河套平原灌溉冬春麦区"], None),
    ("106.5", "110.8", "33.8", "35.8", "陕西省", ["关中平原冬小麦核心主产区"], None),
    ("106", "111", "31.5", "33.8o", "陕西省", ["陕南秦巴汉中盆地麦区"], None),
    ("107", "111.2", "35.8o", "39.5", "陕西省", ["陕北黄土高原丘陵旱作麦区"], None),
    ("96o", "108.5", "33", "42", "甘肃省", ["河西走廊绿洲灌溉麦区", "陇东/陇中旱作冬小麦区"], ("lon", 103.0)),
    ("110", "114.5", "34.5", "40.5", "山西省", ["汾河谷地/晋南盆地冬小麦区"], None),
    ("113.8", "115.5", "31.5", "33.2", "河南省", ["豫南淮河流域冬小麦水稻轮作区"], None),
    ("110.8", "113.8", "32.2", "33.8", "河南省", ["南阳盆地优质冬小麦区"], None),
    ("112.2", "116.5", "33", "36.5", "河南省", ["黄淮豫中平原冬小麦核心主产区"], None),
    ("113.8", "119.5", "40.5", "42.5", "河北省", ["冀北张家口坝上优质小麦区"], None),
    ("115.5", "118.5", "38.6o", "40.8", "河北省", ["京津冀都市圈优质冬小麦区"], None),
    ("114", "118.5", "36", "38.6", "河北省", ["冀中南低洼平原优质麦区"], None),
    ("115", "122.8", "34.4", "38.5", "山东省", ["鲁西平原/黄河三角洲冬麦区"], None),
    ("114.8", "119.5", "29.8", "34.6", "安徽省", ["皖江平原沿江优势冬麦水稻区", "淮北平原沿淮优势冬小麦区"], ("lat", 31.8)),
    ("116.8", "122.2", "31", "35.3", "江苏省", ["苏北平原淮北冬小麦优势区"], None),
    ("110.8", "113.5", "31.5", "32.5o", "湖北省", ["襄阳平原优质小麦优势区"], None),
    ("111", "116.5", "29.5", "31.5o", "湖北省", ["江汉平原两熟制冬麦水稻轮作区"], None),
    ("101", "110", "26", "33", "四川省", ["川西南攀西山地早熟麦区", "四川盆地丘陵冬小麦区"], ("lat", 28.5)),
    ("98", "109.5", "23", "29", "云南省/贵州省", ["云贵高原冬春麦区"], None),
    ("118", "122.5", "46", "53.5", "内蒙古自治区", ["呼伦贝尔/兴安盟农牧交错带优质麦区"], None),
    ("122.5o", "135", "43", "53.5", "黑龙江省", ["松嫩平原寒地优质早熟小麦区"], None),
    ("44", "50", "29", "34", "胡齐斯坦灌溉平原区", ["卡伦河流域甘蔗与冬小麦优质主产带"], None),
]
ABROAD = ("国际重点农业示范区", "全球优势农作物集约化灌溉片区")
HOME = ("全国重要农区", "全国重要农作物优势聚集片区")
HOME_BOX = (73.0, 135.0, 18.0, 54.0)


def _within(x: Column, low: str, high: str) -> Column:
    a, b = float(low.rstrip("o")), float(high.rstrip("o"))
    return ((x > a) if low.endswith("o") else (x >= a)) & ((x < b) if high.endswith("o") else (x <= b))


def zone(lon: Column, lat: Column) -> Column:
    """struct(province, zone) by the first rule that holds: one cascade, no join."""
    axes = {"lon": lon, "lat": lat}
    out = None
    for west, east, south, north, province, names, cut in RULES:
        name = F.lit(names[0]) if cut is None else F.when(axes[cut[0]] < cut[1], names[0]).otherwise(names[1])
        holds = _within(lon, west, east) & _within(lat, south, north)
        value = F.struct(F.lit(province).alias("province"), name.alias("zone"))
        out = F.when(holds, value) if out is None else out.when(holds, value)
    inside = lon.between(*HOME_BOX[:2]) & lat.between(*HOME_BOX[2:])
    pair = lambda x: F.struct(F.lit(x[0]).alias("province"), F.lit(x[1]).alias("zone"))
    return out.when(~inside, pair(ABROAD)).otherwise(pair(HOME))


def rule_table(spark: SparkSession) -> DataFrame:
    """The rules as rows, for range joins and for reading."""
    rows = [
        (i, float(w.rstrip("o")), w[-1] == "o", float(e.rstrip("o")), e[-1] == "o", float(s.rstrip("o")), s[-1] == "o", float(n.rstrip("o")), n[-1] == "o", p, z[0], z[-1], c[0] if c else None, c[1] if c else None)
        for i, (w, e, s, n, p, z, c) in enumerate(RULES)
    ]
    return spark.createDataFrame(rows, "rule int, west double, west_open boolean, east double, east_open boolean, south double, south_open boolean, north double, north_open boolean, province string, zone_below string, zone_above string, axis string, cut double")


def zone_join(points: DataFrame, lon: str = "lon", lat: str = "lat") -> DataFrame:
    """The same as a range join: each point keeps its first matching rule. The 24 rules are the broadcast side."""
    rules = F.broadcast(rule_table(points.sparkSession))
    x, y = F.col(lon), F.col(lat)
    edge = lambda v, low, low_open, high, high_open: ((v > F.col(low)) | ((v == F.col(low)) & ~F.col(low_open))) & ((v < F.col(high)) | ((v == F.col(high)) & ~F.col(high_open)))
    keyed = points.withColumn("_point", F.monotonically_increasing_id())
    name = F.when(F.col("axis").isNull() | (F.when(F.col("axis") == "lat", y).otherwise(x) < F.col("cut")), F.col("zone_below")).otherwise(F.col("zone_above"))
    met = keyed.join(rules, edge(x, "west", "west_open", "east", "east_open") & edge(y, "south", "south_open", "north", "north_open"), "left")
    first = met.groupBy("_point", *points.columns).agg(F.min_by(F.struct("province", name.alias("zone")), "rule").alias("z"))
    inside = x.between(*HOME_BOX[:2]) & y.between(*HOME_BOX[2:])
    other = lambda i: F.when(~inside, ABROAD[i]).otherwise(HOME[i])
    return first.select(*points.columns, F.coalesce("z.province", other(0)).alias("province"), F.coalesce("z.zone", other(1)).alias("zone"))


#: Fixed values.
SUITABILITY = (
    "优 (特大型规模化集中作业区)", "优 (大型连片标准农田)", "优 (中型规整高效适机区)", "良 (中型连片作业区)", "良 (标准适机田块)", "良 (基本适机)", "中/碎 (建议并块平整)",
)
TIERS = ("特大型现代农业大田 (>3000亩)", "大型规整连片田块 (1000~3000亩)", "中型标准农田单元 (300~1000亩)", "中小型家庭经营田 (50~300亩)", "细碎零星小地块 (<50亩)")


def suitability(mu: Column, compactness: Column) -> Column:
    """For which machines a parcel suits, from its area and how compact it is."""
    s = SUITABILITY
    return (
        F.when(mu >= 3000, s[0]).when(mu >= 1000, s[1]).when((mu >= 200) & (compactness >= 0.10), s[2]).when(mu >= 200, s[3])
        .when((compactness >= 0.35) & (mu >= 30), s[4]).when((compactness >= 0.20) & (mu >= 5), s[5]).otherwise(s[6])
    )


def tier(mu: Column) -> Column:
    return F.when(mu >= 3000, TIERS[0]).when(mu >= 1000, TIERS[1]).when(mu >= 300, TIERS[2]).when(mu >= 50, TIERS[3]).otherwise(TIERS[4])
