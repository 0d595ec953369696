"""Table schemas and the fixed dimension lists of the chili price panel."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

PRICE_SCHEMA = T.StructType([
    T.StructField("tanggal", T.DateType()),
    T.StructField("provinsi", T.StringType()),
    T.StructField("jenis_cabai", T.StringType()),
    T.StructField("harga", T.IntegerType()),
])

SHOP_SCHEMA = T.StructType([
    T.StructField("nama_toko", T.StringType()),
    T.StructField("platform", T.StringType()),
    T.StructField("nama_produk", T.StringType()),
    T.StructField("jenis_cabai", T.StringType()),
    T.StructField("harga", T.IntegerType()),
    T.StructField("satuan", T.StringType()),
    T.StructField("lokasi", T.StringType()),
    T.StructField("rating", T.FloatType()),
    T.StructField("link_toko", T.StringType()),
    T.StructField("gambar_toko", T.StringType()),
])

PAGE_SCHEMA = T.StructType([
    T.StructField("jenis_cabai", T.StringType()),
    T.StructField("html", T.StringType()),
])

REQUEST_SCHEMA = T.StructType([
    T.StructField("provinsi", T.StringType()),
    T.StructField("jenis_cabai", T.StringType()),
    T.StructField("durasi", T.IntegerType()),
])

# The supported provinces, in the order of their one-hot slots.
PROVINCES = (
    "Aceh", "Bali", "Banten", "Bengkulu", "DI Yogyakarta", "DKI Jakarta", "Gorontalo", "Jambi",
    "Jawa Barat", "Jawa Tengah", "Jawa Timur", "Kalimantan Barat", "Kalimantan Selatan",
    "Kalimantan Tengah", "Kalimantan Timur", "Kalimantan Utara", "Kepulauan Bangka Belitung",
    "Kepulauan Riau", "Lampung", "Maluku", "Maluku Utara", "Nusa Tenggara Barat",
    "Nusa Tenggara Timur", "Papua", "Papua Barat", "Riau", "Sulawesi Barat", "Sulawesi Selatan",
    "Sulawesi Tengah", "Sulawesi Tenggara", "Sulawesi Utara", "Sumatera Barat",
    "Sumatera Selatan", "Sumatera Utara",
)

# The supported commodities, in the order of their one-hot slots.
COMMODITIES = (
    "Cabai Merah Besar", "Cabai Merah Keriting", "Cabai Rawit Hijau", "Cabai Rawit Merah",
)

# Commodities whose prices move together.
SUBSTITUTES = {
    "Cabai Rawit Hijau": "Cabai Rawit Merah",
    "Cabai Rawit Merah": "Cabai Rawit Hijau",
    "Cabai Merah Keriting": "Cabai Merah Besar",
    "Cabai Merah Besar": "Cabai Merah Keriting",
}

# Inclusive price ranges of simulated prices, and the range of any other commodity.
PRICE_RANGES = {
    "Cabai Merah Besar": (30_000, 55_000),
    "Cabai Merah Keriting": (35_000, 60_000),
    "Cabai Rawit Merah": (40_000, 80_000),
    "Cabai Rawit Hijau": (30_000, 50_000),
}
DEFAULT_PRICE_RANGE = (30_000, 60_000)

# The lags of the model, the training share and the highest plausible price.
LAG = 7
TRAIN_SHARE = 0.7
MAX_PRICE = 500_000

# Columns a shop file must have.
SHOP_FILE_COLUMNS = (
    "nama_toko", "platform", "nama_produk", "jenis_cabai", "harga", "satuan", "lokasi", "rating",
    "link_toko", "gambar_produk",
)


def dimension(spark: SparkSession, names, column: str = "name") -> DataFrame:
    """A dimension list as a frame of ``(name, idx)``; ``idx`` is the one-hot slot."""
    rows = [(name, idx) for idx, name in enumerate(sorted(names))]
    return spark.createDataFrame(rows, f"{column} string, idx int")


def substitutes(spark: SparkSession, pairs: dict[str, str] = SUBSTITUTES) -> DataFrame:
    return spark.createDataFrame(list(pairs.items()), "item string, substitute string")
