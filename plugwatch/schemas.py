"""Explicit schemas of the sources and tables, as DDL text."""

from __future__ import annotations

# A spec column: contexts in first-seen order, each with its distinct values in order.
SPEC_DDL = "array<struct<context:string,values:array<string>>>"

RAW_PRODUCT = (
    "product_id string, title string, text string, url string, seller_id string,"
    " seller_name string, query string, category string, manufacturer string,"
    " images array<string>"
)
RAW_REVIEW = ("product_id string, reviews array<struct<content:string,rating:int>>")

PRODUCTS = (
    "product_id string, marketplace string, product_group string, title string, text string,"
    f" url string, seller_id string, amperage_info {SPEC_DDL}, voltage_info {SPEC_DDL},"
    f" wattage_info {SPEC_DDL}, query string, category string, manufacturer string"
)
SCORED_REVIEWS = (
    "product_id string, marketplace string, review_text string, negativity_score double,"
    " danger_score double"
)
REVIEW_SCORES = (
    "product_id string, marketplace string, negativity_score double, danger_score double,"
    " review_count bigint"
)
IMAGE_PREDICTIONS = ("product_id string, predictions array<map<string,double>>")
IRRELEVANT_PAIRS = ("product_id string, product_group string")
SPOT_CHECKS = (
    "product_id string, product_group string, compliant_flag int, non_compliant_flag int,"
    " ambiguous_flag int, irrelevant_product_flag int"
)
COEFFICIENTS = (
    "class string, voltage_score double, amperage_score double, wattage_score double,"
    " is_recall_brand double, adjusted_danger_score double, intercept double"
)
TAGS = ("id bigint, name string")

ANNOTATION_DOCUMENT = (
    "images array<struct<id:bigint,width:int,height:int,file_name:string,coco_url:string,"
    "absolute_url:string>>,"
    " annotations array<struct<image_id:bigint,category_id:bigint,bbox:array<double>>>,"
    " categories array<struct<id:bigint,name:string>>"
)
# Entries of an image list: wrapped in one object, or the rows themselves.
_REGIONS_DDL = ("array<struct<tagId:string,tagName:string,left:double,top:double,width:double,"
                "height:double>>")
IMAGE_ENTRIES = (
    f"images array<struct<url:string,name:string,regions:{_REGIONS_DDL}>>,"
    f" url string, name string, regions {_REGIONS_DDL}"
)

# Tables of the relational store.
SELLERS_TABLE = ("SellerID int not null, Name string not null,"
                        " Marketplace string not null, URL string")
PRODUCTS_TABLE = (
    "ProductID string not null, Marketplace string not null, ProductGroup string not null,"
    " UploadDate timestamp not null, Title string not null, Description string,"
    " Rating decimal(3,2), Price decimal(18,2), Currency string, NumImages int, SellerID int"
)
IMAGES_TABLE = (
    "ImageGUID string not null, ProductID string not null, BlobPath string not null,"
    " Width int not null, Height int not null, Format string not null,"
    " FileSizeBytes bigint not null, Checksum string not null, UploadTs timestamp not null"
)
LABELS_TABLE = (
    "LabelID int not null, ImageGUID string not null, LabelType string not null,"
    " LabelValue string not null, LabeledBy string, LabeledTs timestamp not null"
)
REVIEWS_TABLE = (
    "ReviewID int not null, ProductID string, ReviewText string not null,"
    " Rating int not null, ReviewTs timestamp not null"
)
# Columns, primary key, and references {column: (table, its column)} of each.
TABLES = {
    "Sellers": (SELLERS_TABLE, ("SellerID",), {}),
    "Products": (PRODUCTS_TABLE, ("ProductID",), {"SellerID": ("Sellers", "SellerID")}),
    "Images": (IMAGES_TABLE, ("ImageGUID",), {"ProductID": ("Products", "ProductID")}),
    "Labels": (LABELS_TABLE, ("LabelID",), {"ImageGUID": ("Images", "ImageGUID")}),
    "Reviews": (REVIEWS_TABLE, ("ReviewID",), {"ProductID": ("Products", "ProductID")}),
}
