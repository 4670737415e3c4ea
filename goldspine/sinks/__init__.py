"""Writers, staging and manifests of written files."""
