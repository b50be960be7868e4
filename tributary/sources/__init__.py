"""Sources: files and bundles, paged APIs, and the catalogue of known feeds."""
