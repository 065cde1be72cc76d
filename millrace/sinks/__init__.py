"""Writers: landed batches, table versions, packed blobs, CSV and JDBC."""
