"""skumix: segment products by how they sell, as Spark jobs.

Every public function takes and returns DataFrames; only model metrics
and cluster centers (a few hundred numbers) ever reach the driver.
"""

__version__ = "0.1.0"

# Column names of the product feature table, used across the package.
PRODUCT_ID = "product_id"
PRODUCT_NAME = "product_name"
VOLUME = "volume"
FREQUENCY = "order_frequency"
CUSTOMERS = "unique_customers"
CONCENTRATION = "concentration"

# The four profiled features, and the three the models are fitted on
# (unique customers is described but not clustered on).
ALL_FEATURES = (VOLUME, FREQUENCY, CUSTOMERS, CONCENTRATION)
MODEL_FEATURES = (VOLUME, FREQUENCY, CONCENTRATION)
