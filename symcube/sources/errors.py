"""What can go wrong with a bundle."""


class BundleError(RuntimeError):
    """Base of all errors of this package."""


class InvalidPathError(BundleError):
    """The path cannot be used."""


class CreateError(BundleError):
    """A bundle could not be created."""


class OpenReadError(BundleError):
    """The path holds no complete bundle."""


class OpenWriteError(BundleError):
    """The path cannot be written."""


class InvalidWriteInputError(BundleError):
    """A symbol does not fit the data model; nothing was written."""


class SymbolNotFoundError(BundleError, ValueError):
    """The bundle has no symbol of this name."""


class ClosedError(BundleError):
    """The bundle was closed."""


class IntegrityError(BundleError):
    """A symbol did not deliver the records that the catalog promises."""
