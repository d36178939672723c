"""oreflow: change-data trades refined on Spark, topic -> bronze -> silver -> gold."""
