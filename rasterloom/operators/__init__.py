"""DataFrame operators on metadata, file inventories and image tables."""
