"""Writers: landed snapshots, versioned tables, exports and file layout."""
