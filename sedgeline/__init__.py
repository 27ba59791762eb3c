"""sedgeline: Spark-native curation of public-sector tables and documents."""
