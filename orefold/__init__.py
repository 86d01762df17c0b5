"""orefold: a Spark-native retail medallion engine (raw -> curated -> star -> reports)."""
