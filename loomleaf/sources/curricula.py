"""The catalog of public curriculum documents, as rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

BASE = "https://www.naer.edu.tw/upload/1/"
# Domain, name, address below BASE, date of each published document; and the orders that put the guidelines in force.
DOCUMENTS = (
    ("總綱", "十二年國教課程綱要總綱", "16/doc/288/十二年國教課程綱要總綱.pdf", "103-11-28"),
    ("總綱", "十二年國教課程綱要總綱（111學年度實施）", "16/doc/288/(111學年度實施)十二年國教課程綱要總綱.pdf", "110-03-15"),
    ("國語文", "國語文課程綱要", "16/doc/806/十二年國民基本教育課程綱要國民中小學暨普通型高級中等學校(語文領域─國語文).pdf", "107-01-25"),
    ("英語文", "英語文課程綱要", "16/doc/812/(發布版)國民中小學暨普通型高級中等學校-語文領域-英語文課程綱要.pdf", "107-04-16"),
    ("英語文", "第二外國語文課程綱要", "16/doc/812/(發布版)國民中學暨普通型高級中等學校-語文領域-第二外國語文課程綱要.pdf", "107-04-16"),
    ("本土語文", "閩南語文課程綱要", "16/doc/1278/十二年國民基本教育課程綱要國民中小學語文領域-本土語文(閩南語文).pdf", "107-03-02"),
    ("本土語文", "客家語文課程綱要", "16/doc/1280/十二年國民基本教育課程綱要國民中小學語文領域-本土語文(客家語文).pdf", "107-03-02"),
    ("本土語文", "原住民族語文課程綱要", "16/doc/1282/十二年國民基本教育課程綱要國民中小學語文領域-本土語文(原住民族語文).pdf", "107-03-02"),
    ("本土語文", "新住民語文課程綱要", "16/doc/1283/十二年國民基本教育課程綱要國民中小學語文領域-新住民語文.pdf", "107-03-02"),
    ("本土語文", "臺灣手語課程綱要", "9/doc/3393/十二年國民基本教育課程綱要語文領域-臺灣手語-發布版.pdf", "110-12-10"),
    ("本土語文", "閩東語文課程綱要", "9/doc/3444/(111學年度實施)十二年國民基本教育課程綱要語文領域-本土語文(閩東語文)-發布版.pdf", "110-12-27"),
    ("數學", "數學領域課程綱要", "16/doc/815/十二年國民基本教育課程綱要國民中小學暨普通型高級中等學校-數學領域.pdf", "107-07-26"),
    ("自然科學", "自然科學領域課程綱要", "16/doc/820/十二年國民基本教育課程綱要國民中小學暨普通型高級中等校-自然科學領域.pdf", "107-11-02"),
    ("社會", "社會領域課程綱要", "16/doc/819/十二年國民基本教育課程綱要國民中小學暨普通型高級中等校-社會領域.pdf", "107-10-26"),
    ("藝術", "藝術領域課程綱要", "16/doc/818/十二年國民基本教育課程綱要國民中小學暨普通型高級中等校-藝術領域.pdf", "107-10-23"),
    ("綜合活動", "綜合活動領域課程綱要", "16/doc/817/十二年國民基本教育課程綱要國民中小學暨普通型高級中等校-綜合活動領域.pdf", "107-10-23"),
    ("科技", "科技領域課程綱要", "16/doc/816/十二年國民基本教育課程綱要國民中學暨普通型高級中等學校-科技領域.pdf", "107-09-20"),
    ("健康與體育", "健康與體育領域課程綱要", "16/doc/814/十二年國民基本教育課程綱要國民中小學暨普通型高級中等學校-健康與體育領域.pdf", "107-06-08"),
    ("健康與體育", "生活課程課程綱要（國小）", "16/doc/813/(發布版)生活課程課程綱要.pdf", "107-04-16"),
    ("國防", "全民國防教育課程綱要", "16/doc/811/十二年國民基本教育課程綱要-全民國防教育.pdf", "107-03-02"),
)
ORDERS = (
    (None, "十二年國教總綱發布令", "16/doc/288/103年11月28日教育部發布令.pdf", "103-11-28"),
    (None, "十二年國教總綱修正發布令", "16/doc/288/106年5月10日教育部修正發布令.pdf", "106-05-10"),
    (None, "十二年國教總綱修正發布令（111學年度）", "16/doc/288/110年3月15日教育部修正發布令.pdf", "110-03-15"),
)


def curricula(spark: SparkSession) -> DataFrame:
    """kind (document or order), domain, name, url, published_date; 23 rows."""
    rows = [("document", *d) for d in DOCUMENTS] + [("order", *o) for o in ORDERS]
    return spark.createDataFrame([(k, d, n, BASE + u, t) for k, d, n, u, t in rows], "kind string, domain string, name string, url string, published_date string")
