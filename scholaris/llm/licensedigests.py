"""Digests of the canonical forms of long license texts, by SPDX name.

Made with `licenses.canonical_lines` from the texts that operating systems and packages
ship; those with an appendix also without it. They change with the canonical form.
"""

DIGESTS = (
    ("Apache-2.0", "045649cdaf85384ba827242062f2f3b36409835c98d297e25177cb1faf7c2847"),
    ("Apache-2.0", "6ed232a1aaf66db92997c53c056b853f2a64b9f74585489f71cbae1bb4d6d166"),
    ("Apache-2.0", "108490d21e2d3edc9128233e48fabc169818d0c7c5f0bbdd58231a367d2d6c87"),
    ("Artistic-1.0-Perl", "08f1dc258c8f9e175155356aa1dd0dead8cfdec586bc1bb4c8b1452699a91702"),
    ("CC0-1.0", "96bdc7f63190fb4bd1ae584b890300ed7517d858b34c945642a3b9b2f1612a5f"),
    ("GFDL-1.2", "94541e73869af10ab6bd68a29575eede324e54e7d5237e7386d12444f593af60"),
    ("GFDL-1.3", "a92fdbaeafedd9cbeb812ebbded06ee07e3b1427c81cfc333e682109c594d826"),
    ("GPL-1.0", "8f586b09c093668e2db772bdcfc1d5dc0b03e0e862fccbff035e1bf134e9b224"),
    ("GPL-2.0", "efe73660e5476cf0368fc0fc143f624ff9d1b73c4484b14a9969dd20c5786821"),
    ("GPL-2.0", "6d332dc4c3c5293a73c6c9da402f9bbc970b3bb1eb472f577e00580573469808"),
    ("GPL-2.0", "e1270b653c300290e7c039142bccb8776f9b5d14e8a05bc4e87dc7d1614a3b34"),
    ("GPL-3.0", "5fc5b48e8eeed6e5e77c32ad8641a6bc04d25011d6b500aa7dc7f3183ab812ea"),
    ("GPL-3.0", "3c7dd1dab9b12497c332318fc0edfdef5dfe1e9c0deca666be888aaab64b125d"),
    ("GPL-3.0", "7e1ec759902e79fd98df32aeafb56e0fcc9348cebf7b52c7a875052ac012ad4a"),
    ("LGPL-2.0", "61af4dcea4e412e8ccfb8877fd2762bd6d962f8d42a9fa2c06cf7b4613f2c908"),
    ("LGPL-2.0", "430627da7218a92ab4a6d75d5140cdb70ee750be7a53f913299b37e0d1b0eea2"),
    ("LGPL-2.0", "504542bce5421b0f5a7e63ddb55443ccb300b27a65ba6bfc1370fed16a3af260"),
    ("LGPL-2.1", "4d55922bdeafabde164d75448bbfb0b474bf952bbb541325364010900acd9891"),
    ("LGPL-2.1", "bf2f0c6bf1c47b3b1e3cbedeefecddd1e7db21d1919858d45c2f918efaf426df"),
    ("LGPL-2.1", "48d2010e70a815a564f914b0c7c1e80d7a6843793348fed3684c957112fe0aa4"),
    ("LGPL-3.0", "aae2b222477171fb64e298e7965e768a9a6f85320646b266c94399ac029d42be"),
    ("MPL-1.1", "f77c59051c0127d677dcce7ba0d4733294974749a7b4155250912498d92767d6"),
    ("MPL-2.0", "95f6a0d094cf3da6a140310541c7b576789031b600469b70877b34f97918e4c9"),
    ("Unlicense", "7a4d92cdb11d254973a073803be1148a5402f1b2ca67808cdb3ef78b596102cd"),
    ("Unlicense", "6077a8a20d606206e486caec85a30b2545701071b1e08d12c37fb9a0e490d1bf"),
    ("Unlicense", "41f84c538b3bc6dcfe6afaab48f6e16c34fd1b11b2c6be7db47873ba3bce291a"),
    ("BSL-1.0", "5fcf89bde8c0c2deb999f4cc626e1aebf90e80fdc5cd334dae008152ef4a1ded"),
    ("BSL-1.0", "4f4c9e65217414246c604405ee4900201bd9f230d226fa803a0b7a1f5775bf85"),
    ("Unicode-3.0", "53113a39b79251016cf92b8348f303cee44e4faee1f232536754abc669dd32c8"),
)
