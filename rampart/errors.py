"""Exception types raised while building or running a plan."""


class ContractError(ValueError):
    """A table contract is malformed (unknown type, rule or transform)."""


class ValidationError(Exception):
    """A landing file failed a file gate."""


class LoadError(Exception):
    """A load strategy refused the incoming data (key conflict, constraint)."""


class StageError(RuntimeError):
    """A pipeline stage failed; the message is ``FAILED_AT_[stage]: reason``."""

    def __init__(self, stage: str, cause: BaseException):
        super().__init__(f"FAILED_AT_[{stage}]: {cause}")
        self.stage = stage
        self.cause = cause
