"""Writers of the published tables and documents."""
