"""PySpark-native analytics over chat logs: parsing, cleaning, ordered features, context windows and reports."""
